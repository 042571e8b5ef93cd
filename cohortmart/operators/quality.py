"""Data-quality checks: key uniqueness, NULL demographics, value types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmart.functions.columns import qcol, valid_valtype

# i2b2 primary key of observation_fact
FACT_KEY = ("encounter_num", "concept_cd", "provider_id", "instance_num", "start_date",
            "modifier_cd")


def key_violations(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their count (partial aggregate)."""
    return (df.groupBy(*[qcol(c) for c in key_cols]).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def null_demographics(demo: DataFrame, key_cols: Sequence[str],
                      checked: Sequence[str] = ("age", "sex_cd")) -> DataFrame:
    """Subjects whose age or gender is NULL (these stop an export under ``fail``)."""
    cond = None
    for c in checked:
        cond = qcol(c).isNull() if cond is None else cond | qcol(c).isNull()
    return demo.filter(cond).select(*[qcol(c) for c in (*key_cols, *checked)])


def bad_valtype(facts: DataFrame) -> DataFrame:
    """Reject table: facts whose value type is neither N nor T (or NULL)."""
    return facts.filter(~valid_valtype(F.col("valtype_cd")) | F.col("valtype_cd").isNull())

