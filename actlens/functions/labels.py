"""Fixed values that results must carry verbatim.

FIXED VALUES — these strings and numbers are part of the output contract of
the analysis (labels shown to users, action names read from the data, the
timestamp format of the input files and the default thresholds).  They are
listed here once, in their natural order, and referenced everywhere else.
"""

# The three funnel actions, in funnel order.
VIEW = "view"
CART = "cart"
PURCHASE = "purchase"
ACTIONS = (VIEW, CART, PURCHASE)

# Timestamp layout of the activity files.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Separator between actions in a session sequence.
SEQUENCE_SEP = " → "

# Funnel stage labels (batch set).
STAGE_COMPLETE = "Complete (View→Cart→Purchase)"
STAGE_PARTIAL = "Partial (View→Cart)"
STAGE_BROWSE = "Browse Only (View)"

# Anomaly flag labels (batch set).
FLAG_HIGH = "HIGH RISK - Never Purchased"
FLAG_MODERATE = "MODERATE RISK - Low Conversion"
FLAG_NORMAL = "NORMAL"

# Dashboard label set, selectable instead of the batch set.
DASHBOARD_FLAG_HIGH = "HIGH RISK"
DASHBOARD_FLAG_MODERATE = "MODERATE"
DASHBOARD_STAGE_BROWSE = "Browse Only"

# The dashboard's anomaly rules: ratio at one digit, shorter labels.
# Usage: profile(df, **DASHBOARD_RULES).
DASHBOARD_RULES = {"digits": 1, "high": DASHBOARD_FLAG_HIGH, "moderate": DASHBOARD_FLAG_MODERATE}

# Hyperactivity labels.
BEHAVIOR_SUSPECTED = "BOT / HYPERACTIVE SUSPECTED"
BEHAVIOR_NORMAL = "Normal User"

# Funnel reach stage names, in funnel order.
REACH_VIEWED = "Viewed"
REACH_CARTED = "Added to Cart"
REACH_PURCHASED = "Purchased"

# Default thresholds of the anomaly rules.
MIN_VIEWS_NO_PURCHASE = 5   # HIGH: at least this many views and no purchase
MAX_VIEW_RATIO = 8          # MODERATE: rounded views/purchases above this
RATIO_DIGITS = 2            # digits of the rounded ratio (dashboard used 1)
STDDEV_K = 2                # hyperactive: views above mean + k * stddev
SHARE_DIGITS = 2            # digits of percentage shares

# Display columns of the raw-data preview.
PREVIEW_COLUMNS = ("user_id", "action", "category", "hour", "device")
