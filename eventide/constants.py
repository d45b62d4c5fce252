"""Fixed values that must equal the behaviour being rebuilt.

Everything here is a default; every operator takes it as a parameter.
"""

from __future__ import annotations

# --- fixed values: base instant and thresholds -------------------------------
# Base instant of click, booking and comment data: 2023-07-15T00:00:00Z.
T0_MS = 1689379200000

ARTICLES = ("the", "a")                # tokens counted by the article job
TOKEN_SPLIT_REGEX = r"\W+"             # split pattern after lower-casing

SESSION_GAP_MS = 3000                  # global click sessions
SLIDING_SIZE_MS = 2000                 # booking / busiest window size
SLIDING_SLIDE_MS = 1000                # booking / busiest window slide
BUSIEST_SESSION_GAP_MS = 30000         # session over sliding-window output
MIN_CLICK_JUMP = 5                     # emit when count rose by more than this
INSTALL_THRESHOLD = 100                # batch closes at this many installs ...
UNINSTALL_THRESHOLD = 50               # ... or this many uninstalls
TOP_APPS = 3                           # top apps per batch
ERROR_REPORT_MS = 10000                # error report window
COMMENT_WINDOW_MS = 10000              # comment pre-batching window
TOP_ACRONYMS = 20                      # top acronyms per period
LATE_AFTER_SECONDS = 3 * 24 * 3600     # a delivery is late after 3 days
QUIET_GAP_SECONDS = 30                 # processing-time report gap
NO_BOOKINGS_TEXT = "No bookings"       # text for a missing min/max

# --- fixed values: event types of the store stream ---------------------------
EVENT_INSTALL = "install"
EVENT_UNINSTALL = "uninstall"
EVENT_PAGE_VIEW = "page_view"
EVENT_ERROR = "error"
STORE_EVENT_TYPES = ("install", "uninstall", "page_view", "error")

# --- fixed values: time of day by UTC hour, [start, end) ---------------------
# The spelling "Mourning" is part of the output.
TIME_OF_DAY = (
    ("Mourning", 4, 12),
    ("Day", 12, 17),
    ("Evening", 17, 24),
    ("Midnight", 0, 4),
)

# --- fixed values: generator weights (dimension, name, probability) ----------
GENERATOR_WEIGHTS = {
    "stores": (
        ("HuaweiAppStore", 0.25),
        ("AppleAppStore", 0.25),
        ("GooglePlay", 0.25),
        ("RuStore", 0.25),
    ),
    "appIds": (
        ("2616001479570096825", 0.25),
        ("4091758100234781984", 0.25),
        ("9102759165103862720", 0.25),
        ("1045619379553910805", 0.25),
    ),
    "eventTypes": (
        ("page_view", 0.25),
        ("install", 0.25),
        ("uninstall", 0.25),
        ("error", 0.25),
    ),
}
GENERATOR_EVENT_TIME_FREQ_MS = 1000
