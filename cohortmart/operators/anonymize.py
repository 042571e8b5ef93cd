"""Anonymization: hash identifier columns of a flat table or of a whole mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortmart.functions.columns import qcol, set_or_append
from cohortmart.functions.hashing import hash_column
from cohortmart.schema import ID_COLUMNS, Mart


def anonymize_flat(df: DataFrame, columns: Sequence[int | str] = (0,), method: str = "sha3_224",
                   dataset: str | None = None) -> DataFrame:
    """Replace the listed columns (positions or names; default the first) by their
    hex digest.  ``dataset`` sets or appends a ``Dataset`` column (documented
    option the reference accepts but ignores)."""
    names = [df.columns[c] if isinstance(c, int) else c for c in columns]
    out = df.select(*[(hash_column(qcol(c), method).alias(c) if c in names else qcol(c))
                      for c in df.columns])
    if dataset is not None:
        out = set_or_append(out, "Dataset", dataset)
    return out


def anonymize_table(df: DataFrame, method: str, id_columns: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Hash every identifier column present; a pure projection (no shuffle)."""
    return df.select(*[(hash_column(qcol(c), method).alias(c) if c in id_columns else qcol(c))
                       for c in df.columns])


def anonymize_mart(mart: Mart, method: str = "sha224", name: str = "anonymized") -> Mart:
    """Same deterministic hash applied to the ids of every table, so joins between
    tables still match; numeric ids become strings."""
    return Mart(**{t: anonymize_table(df, method) for t, df in mart.tables().items()}, name=name)
