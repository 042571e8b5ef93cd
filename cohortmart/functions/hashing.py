"""Identifier hashing: md5 and SHA-224 are built in; SHA3-224 is an Arrow UDF."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_METHODS = ("md5", "sha224", "sha3_224")


@F.pandas_udf(T.StringType())
def _sha3_224(s: pd.Series) -> pd.Series:
    # Arrow batch in, batch out; only hashlib has SHA-3, Spark has no built-in.
    return s.map(lambda v: None if v is None else hashlib.sha3_224(v.encode("utf-8")).hexdigest())


def hash_column(col: Column, method: str = "sha224") -> Column:
    """Hex digest of the value's string form; NULL stays NULL."""
    s = col.cast("string")
    if method == "md5":
        return F.md5(s)
    if method == "sha224":
        return F.sha2(s, 224)
    if method == "sha3_224":
        return _sha3_224(s)
    raise ValueError(f"hash method must be one of {HASH_METHODS}, got {method!r}")


def flat_csv_method(hash_df: str) -> str:
    """The flat-file path maps the ``sha224`` choice to SHA3-224 and ``md5`` to md5."""
    if hash_df == "sha224":
        return "sha3_224"
    if hash_df == "md5":
        return "md5"
    raise ValueError(f"hash choice must be md5 or sha224, got {hash_df!r}")
