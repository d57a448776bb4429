"""Every registered query against its SQL, and the rules the repository keeps."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as contract
import compare

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(contract.__file__).parent


@pytest.fixture(scope="module")
def oracle():
    return compare.views(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, oracle, name):
    verdict = compare.compare(spark, oracle, SF_DIR, name)
    assert not verdict.startswith("FAIL"), verdict
    assert verdict.startswith("ok") or name not in contract.oracle_sql()


def test_entry(spark):
    assert contract.entry(spark).columns == ["bd_date", "bd_btime", "tape_code", "base_mi", "view_time_cd", "view_cnt"]


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_library_stays_in_the_jvm_and_off_the_driver():
    forbidden = re.compile(r"\blocalCheckpoint\b|\.toPandas\b|\.rdd\b|crossJoin|@udf|pandas_udf|mapPartitions|/tmp\b")
    for path in (ROOT / "slotwise").rglob("*.py"):
        assert not forbidden.search(path.read_text()), path
