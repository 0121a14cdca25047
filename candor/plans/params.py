"""Parameters the registered fixture queries pass to the operators.

The test behaviour spans 1995-2001, so windows are widened against AS_OF exactly as
FIXTURES.md section 3 says; every other threshold is the operator default.
"""

from __future__ import annotations

from ..functions.scalars import ymd_days_before
from ..sources.fixtures import AS_OF, EVENTS_AS_OF

HOT_DAYS = 90
HOT_SINCE_DAY = ymd_days_before(AS_OF, HOT_DAYS)       # pool create-day bound
COMMUNITY_DAYS = 90
REVIEW_SINCE_DAY = "20000101"
BOOT_DAYS = 30
I2I_MIN_SCORE = 0.2                                      # fixture vectors are nearly orthogonal
KNN_K = 200

__all__ = ["AS_OF", "EVENTS_AS_OF", "HOT_DAYS", "HOT_SINCE_DAY", "COMMUNITY_DAYS", "REVIEW_SINCE_DAY",
           "BOOT_DAYS", "I2I_MIN_SCORE", "KNN_K"]
