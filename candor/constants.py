"""Fixed values that must equal the upstream job's for identical results.

Everything here is stated plainly, in its natural order; operators take these as
keyword defaults so a caller can override any of them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (domain constants)
# ---------------------------------------------------------------------------
DAY = 86400
VIDEO_PTYPE = 5                 # ptype 5 is video; every other type is an image/text post
DEFAULT_PART2 = 72              # partition used when a topic has no partition
DEFAULT_AGE = 0
DEFAULT_GENDER = 0
RESOURCE_PART2 = 80             # resource-type partition, never cold-started
SMOOTHING_EXPOSE = 200          # rate denominator is SUM(expose) + 200

# Hot base filter
HOT_MIN_REVIEW = 20
HOT_MIN_REC = 1000
HOT_MIN_CTR_IMG = 0.3
HOT_MIN_CTR_VIDEO = 0.4
HOT_MIN_REVIEW_RATIO = 0.001

# Engagement caps applied before summing
CAP_STAY_TIME = 300
CAP_DETAIL_DUR = 600
CAP_PLAY_VIDEO_DUR = 300
CAP_REVIEW = 2
CAP_VIEW_IMG_DUR = 300
CAP_COMMENT_DUR = 600

# Robust bounds
P_LO = 0.15
P_HI = 0.95
PERCENTILE_SCALE = 100000

# Hot score weights (video, then image). All 15 gender x age cells use the same weights.
VIDEO_WEIGHTS = {
    "sume_norm": 0.32, "like_norm": 0.2, "share_norm": 0.2, "download_norm": 0.2,
    "dur_norm": 0.3, "detail_dur_norm": 0.2, "play_rate_norm": 0.3, "play_video_norm": 0.3,
    "review_rate_norm": 0.4, "detail_norm": 0.4,
}
IMG_WEIGHTS = {
    "sume_norm": 0.34, "like_norm": 0.2, "share_norm": 0.2, "download_norm": 0.2,
    "dur_norm": 0.2, "detail_dur_norm": 0.2, "review_rate_norm": 0.4, "detail_norm": 0.4,
}
WEIGHT_GENDERS = (0, 1, 2)
WEIGHT_AGES = (0, 1, 2, 3, 4)

# Index sinks
INDEX_TTL_HOT = 30 * DAY
INDEX_TTL_COMMUNITY = 3 * DAY
INDEX_TTL_I2I = 2 * DAY
HOT_TOP = 50000
HOT_MIN_LIMIT = 200
I2I_LIMIT = 100

# Community review
COMMUNITY_TAGS = (1040, 1050)
COMMUNITY_MAX_REVIEW = 20
COMMUNITY_MAX_REC = 10000

# Pool clean
POOL_OLD_AGE = 30 * DAY
POOL_VERY_OLD_AGE = 120 * DAY
POOL_MIN_REC = 1000
POOL_MIN_CHOICE_STATUS = 30
POOL_MIN_RATE = 0.003
POOL_RATE_SMOOTHING = 10.0
POOL_OVERRIDE_SINCE_CT = 1595174400
CENSOR_TAG_VULGAR = 2
CENSOR_TAG_SEXY = 1

# Review board
REVIEW_MIN_COUNT = 5
REVIEW_MIN_RATE = 0.004

# Item-to-item
I2I_POST_MAX_AGE = 30 * DAY
I2I_MIN_REC_OLD = 1000
I2I_TOPN = 200
I2I_MIN_SCORE = 0.5
I2I_IMG_PTYPES = (2, 4)          # inclusive range of image neighbour types
GATE_VIDEO_MIN_CTR = 0.35
GATE_IMG_MIN_CTR = 0.25
GATE_MIN_DOWNLOAD_RATE = 2.5
GATE_MIN_LIKE_RATE = 5.0
GATE_VIDEO_LIKE_RATE = 9.0
GATE_VIDEO_AVG_PLAY = 15.0
STANDARD_MIN_PCNT = 10
STANDARD_DEFAULT = 9.0
STANDARD_CAP = 20.0

# Word2vec function defaults
W2V_SIZE = 100
W2V_WINDOW = 5
W2V_MIN_COUNT = 5
W2V_EPOCHS = 5

# Cold start
BOOT_WINDOW = 3 * DAY
BOOT_OVERRIDE_MIN_GAP = 3600
BOOT_SIBLING_MAX_REC = 10000
BOOT_SIBLING_MIN_STEP = 10
MOVER_EXCLUDED_PARTS = (58, 59, 145, 148, 51, 77, 81, 82, 83, 107, 110, 111, 149, 56, 87, 88)
MOVER_RESCUE_STEP1 = (7800, 8100)    # seconds since step_boot_t, (low exclusive, high inclusive]
MOVER_RESCUE_STEP2_AFTER = 43200
VIDEO_PLAY_MIN_AVG = 10
VIDEO_PLAY_MIN_RATE = 0.2
WEIGHT_ONLY_S1 = (1.2, 1.0)
WEIGHT_ONLY_S2 = (1.5,)
WEIGHT_S1_DAMPED = 0.8
WEIGHT_S1_MIN_REC = 20

# Step ladder (type -> steps in order): expose_to threshold and rule text.
STEP_RULES_YAML = """\
video:
  - { step: 0, expose_to: 200, rule: '' }
  - { step: 1, expose_to: 500, rule: 't-step_boot_t <= 7800 and vdur >= 5 and (((part1_id == 15 or part1_id == 17) and like + download + share + review + video_play_score >= 4) or (part1_id != 15 and part1_id != 17 and like + download + share + review + video_play_score >= 3)) and ctr > 0.35' }
  - { step: 2, expose_to: 1000, rule: 't-step_boot_t <= 7800 and t-step_boot_t > 600 and rec >= 500 and rec < 1000 and vdur >= 5 and (((part1_id == 15 or part1_id == 17) and download >= 1) or (part1_id != 15 and part1_id != 17 and download >= 0)) and (download/rec>0.002 or (like+2*review)/rec>=0.015) and (like + download + share + review)/rec >= 0.01 and ctr > 0.35 and ((play_rate>=0.4 and avg_play_dur > 5) or avg_play_dur >= 18)' }
img:
  - { step: 0, expose_to: 100, rule: '' }
  - { step: 1, expose_to: 200, rule: 't-step_boot_t <= 7800 and like + download + share + review > 0' }
  - { step: 2, expose_to: 500, rule: 't-step_boot_t <= 7800 and rec >= 200 and rec < 500 and (download/rec > 0.008 or review > 0)' }
"""
