"""Fixed parameters of the registered queries (FIXTURES.md "Fixed parameters").

"Now" is always an explicit literal so both engines see the same windows.
"""

AS_OF = "2024-01-31 00:00:00"          # raw fixture time
DENSE_AS_OF = "2024-01-01 07:12:00"    # 100x compressed fixture time
TODAY_AS_OF = "2024-01-30 12:00:00"    # a day with data for the "today" count
STATS_START = "2024-01-05"
STATS_END = "2024-01-25"
STATS_LIMIT = 100
TOP_K = 10
TOP_K_FLAGSHIP = 20
OVERVIEW_TOP = 5
OVERVIEW_SHOW = 3
WINDOW_MINUTES = 10
SLIDE_MINUTES = 1
SESSION_GAP_MINUTES = 15
RECENT_N = 50
CACHE_HOURS = 24
LOOKBACK_HOURS = 24
RECENT_DAYS = 7
FRESHNESS_MINUTES = 5
ALERT_MINUTES = 5
ALERT_THRESHOLD = 0.01
PAGE_SIZE = 100
PAGE_NUMBER = 2
BACKFILL_START = "2024-01-10 00:00:00"
BACKFILL_END = "2024-01-17 00:00:00"
EXPIRY_UNTIL = "2024-01-01 06:00:00"     # compressed fixture time
LATE_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
LATE_BEFORE = "2024-01-09 00:00:00"
PAGES = 7
BUCKETS = 8
TOP_STATES_K = 20
LOOKUP_IDS = (1, 100, 101, 555, 702, 1234, 99_999_999)
