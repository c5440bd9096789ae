"""Default parameters."""

# Event codes of the player log and the action code each one stands for.
PLAY_EVENTS = ("122|001|05|007",)
DOWNLOAD_EVENTS = ("080|001|03|007",)
FAVOR_EVENTS = ("083|001|01|007",)
SWITCH_EVENTS = ("099|001|01|007",)
SHARE_EVENTS = ("073|001|01|007", "073|002|01|007", "073|003|01|007", "073|004|01|007")
ACTION_PLAY = 1
ACTION_DOWNLOAD = 2
ACTION_FAVOR = 3
ACTION_SWITCH = 4
ACTION_SHARE = 5
UNKNOWN = "-1"
MIN_APP_VERSION = "6.0"
TIME_DIVISOR = 100
BASKET_PREFIX = "sl_"
USER_PREFIX = "s_"

# Limits of the rule mining and list building stages.
LIST_MIN, LIST_MAX = 2, 100
ITEM_CNT_MIN, ITEM_CNT_MAX = 2, 1_000_000
PAIR_MIN, PAIR_MAX = 2, 1_000_000
RULES_KEPT = 20
ACTION_DAYS = 30
PLAY_MS_MIN = 60 * 1000
PLAY_MS_MAX = 10 * 60 * 1000
PRIOR_DAYS = 7
PRIOR_MAX = 100
RULES_USED = 10
REC_MAX = 300
PER_SINGER_MAX = 3
HOT_MIN = 300
HOT_POOL = 10_000
FILLER_OFFSET = 1000
EXCLUDED_SINGER = "儿歌"

# Text search.
KEYWORD_SPLIT = r"[\s\-]+"
HTML_TAG = r"<[^>]+>"
SNIPPET_BEFORE, SNIPPET_AFTER = 20, 80
