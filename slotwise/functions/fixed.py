"""Values that results depend on and that therefore may not be changed."""

# --- fixed values -----------------------------------------------------------------

# Duration classes: (label, first second of the class). The leading digit sorts them.
# Everything below the second entry, negative durations included, is the first class.
DURATION_CLASSES = (
    ("0.1초미만", None),
    ("1.1-10초", 1),
    ("2.10-30초", 10),
    ("3.30초-1분", 30),
    ("4.1분-2분", 60),
    ("5.2분-3분", 120),
    ("6.3분-4분", 180),
    ("7.4분-5분", 240),
    ("8.5분이상", 300),
)

# Session events that count as an order.
ORDER_EVENTS = ("begin_checkout", "checkout_progress")

# Connection states.
CONNECT = "connect"
DISCONNECT = "disconnect"

# Statistic types of the live table.
VIEWERS_STAT = "DA001"
REVENUE_STAT = "DA002"

# Slot code of competitor rows that are staged but never inserted.
IGNORED_SLOT = "99"

# The wall clock of the business.
TIME_ZONE = "Asia/Seoul"

# --- end of fixed values ----------------------------------------------------------
