from devicepulse.functions.expressions import (
    SENTINELS,
    as_number,
    day_gap,
    hash_bucket,
    null_sentinels,
)

__all__ = ["SENTINELS", "as_number", "day_gap", "hash_bucket", "null_sentinels"]
