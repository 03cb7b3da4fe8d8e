"""Fixed values that results depend on.

FIXED VALUES — these must stay exactly as written; they define what the
pipeline computes and what its data checks accept.
"""

# FIXED VALUES: the seven cities the landing job queries, in this order
# (city label, state code, country code).
CITIES = [
    ("Pittsburgh", "PA", "US"),
    ("New York", "NY", "US"),
    ("Los Angeles", "CA", "US"),
    ("Chicago", "IL", "US"),
    ("Austin", "TX", "US"),
    ("Nashville", "TN", "US"),
    ("Seattle", "WA", "US"),
]
CITY_NAMES = [c[0] for c in CITIES]

# FIXED VALUES: landing limits — events per page and pages kept per city and run.
PAGE_SIZE = 100
MAX_PAGES_PER_CITY = 10

# FIXED VALUES: plausible event-date window around the run date, in years.
PLAUSIBLE_YEARS_BACK = 1
PLAUSIBLE_YEARS_AHEAD = 5

# FIXED VALUES: sale-status codes the fact's data check accepts (severity warn).
ACCEPTED_STATUSES = ["onsale", "offsale", "cancelled", "postponed", "rescheduled"]

# FIXED VALUES: dashboard defaults — top-N genres, look-ahead days of the
# time series, and rows in the upcoming-events table.
TOP_GENRES_N = 10
LOOKAHEAD_DAYS = 30
UPCOMING_ROWS = 200

# FIXED VALUES: text form of timestamps inside surrogate keys and the
# high-water-mark default.
SK_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
HIGH_WATER_MARK_DEFAULT = "1900-01-01 00:00:00"
SK_SEPARATOR = "|"

# Run date used by every as_of-dependent query of the test fixture.
FIXTURE_AS_OF = "2024-01-30"
