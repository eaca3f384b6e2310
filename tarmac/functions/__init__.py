from tarmac.functions.hashing import key_bucket, key_hash
from tarmac.functions.kinds import (
    column_kinds,
    feature_columns,
    numeric_columns,
    string_columns,
)
from tarmac.functions.nulls import nan_to_null, null_flag, null_mask

__all__ = [
    "key_bucket",
    "key_hash",
    "column_kinds",
    "feature_columns",
    "numeric_columns",
    "string_columns",
    "nan_to_null",
    "null_flag",
    "null_mask",
]
