"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_newlines(df: DataFrame) -> DataFrame:
    """Remove ``\\r\\n`` inside every text column; a lone ``\\n`` stays."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(
        [F.replace(_name(c), F.lit("\r\n"), F.lit("")).alias(c) if c in text else _name(c) for c in df.columns]
    )


def clean_date(text: Column, drop_parentheses: bool = True) -> Column:
    """First ten characters of a date text with ``.`` and ``/`` turned into ``-``.

    With ``drop_parentheses`` the parentheses go before the cut; without, the cut comes first
    and parentheses stay, which makes such a text invalid.
    """
    if drop_parentheses:
        return F.substring(F.translate(text, "./()", "--"), 1, 10)
    return F.translate(F.substring(text, 1, 10), "./", "--")


def is_day(text: Column) -> Column:
    """Whether a text is a real ``YYYY-MM-DD`` day; null counts as not."""
    shaped = text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.coalesce(shaped & text.try_cast("date").isNotNull(), F.lit(False))


def _name(column: str) -> Column:
    return F.col(f"`{column}`")
