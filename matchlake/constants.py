"""These must equal the source models' values for the results to match.

They are listed here in their natural order and used by name elsewhere.
The powerplay defaults and playoff codes are the seed CSV files in
``sources/seeds``; the column names and their order are in ``schemas``.
"""

# --- fixed values -----------------------------------------------------------------------------
# start time by matches on the day: one match; two matches (first, second); three or more
SLOT_SINGLE = "19:30"
SLOT_FIRST_OF_TWO = "15:30"
SLOT_SECOND_OF_TWO = "19:30"
SLOT_OTHER = "19:30"

# margin text: '<n> wickets', '<n> runs', otherwise 'no result'
WICKETS_SUFFIX = " wickets"
RUNS_SUFFIX = " runs"
NO_RESULT = "no result"

# match flag by whether a match number is present
FLAG_LEAGUE = "league match"
FLAG_PLAYOFFS = "playoffs"

# points: win, no result, loss
POINTS_WIN = 2
POINTS_NO_RESULT = 1
POINTS_LOSS = 0

# extras that do not count as a legal ball
ILLEGAL_EXTRAS = ("wides", "noballs")

# last name = text after the first word
LAST_NAME_PATTERN = r"^[^ ]+\s+(.*)$"

# time zone of the schedule's local times
SCHEDULE_TIME_ZONE = "Asia/Kolkata"

# accepted order statuses (practice shop)
ORDER_STATUSES = ("placed", "shipped", "completed", "return_pending", "returned")
# -----------------------------------------------------------------------------------------------
