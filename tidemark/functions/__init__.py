from tidemark.functions.binning import interval_label
from tidemark.functions.hashing import hmac_sha256_hex, pseudonym
from tidemark.functions.numeric import half_even, ratio
from tidemark.functions.temporal import day_of_week, elapsed_days, naive_utc, plus_days

__all__ = [
    "day_of_week",
    "elapsed_days",
    "half_even",
    "hmac_sha256_hex",
    "interval_label",
    "naive_utc",
    "plus_days",
    "pseudonym",
    "ratio",
]
