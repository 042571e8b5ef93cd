"""Column expressions used by the jobs (all built-in, whole-stage-codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmart.session import is_case_sensitive

DEC = T.DecimalType(18, 5)

# --- fixed values (must equal the reference's output strings) -------------
# Age bands: (lower bound inclusive, upper bound exclusive or None, label),
# tested in this order, first match wins; NULL age gives NULL; anything that
# matches no band gets the fallback label.  70 <= age < 90 maps to 70-79y as
# in the reference (80-89 never reaches the +80y band).
AGE_BANDS: tuple[tuple[int, int | None, str], ...] = (
    (50, 60, "50-59y"),
    (60, 70, "60-69y"),
    (70, 90, "70-79y"),
    (80, None, "+80y"),
)
AGE_BAND_FALLBACK = "-50y"
# Value types of an EAV fact: numeric and text.
VALTYPE_NUMERIC = "N"
VALTYPE_TEXT = "T"
# --------------------------------------------------------------------------


def qcol(name: str) -> Column:
    """Column by exact name, even when the name contains dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def age_years(age: Column) -> Column:
    """Whole years, ``FLOOR(age)`` as a long."""
    return F.floor(age).cast("long")


def age_months(age: Column) -> Column:
    """Months past the whole year, ``ROUND((age - FLOOR(age)) * 12)``; 0…12, HALF_UP."""
    return F.round((age - F.floor(age)) * F.lit(12), 0)


def age_group(years: Column, bands: Sequence[tuple[int, int | None, str]] = AGE_BANDS,
              fallback: str = AGE_BAND_FALLBACK) -> Column:
    """Band label for whole years; bands are tested in order, first match wins."""
    expr = None
    for lo, hi, label in bands:
        cond = years >= F.lit(lo) if hi is None else (years >= F.lit(lo)) & (years < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = F.lit(fallback) if expr is None else expr.otherwise(F.lit(fallback))
    return F.when(years.isNull(), F.lit(None).cast("string")).otherwise(expr)


def typed_value(valtype: Column, tval: Column, nval: Column) -> Column:
    """Text rendering of a fact value as written into a flat export cell.

    ``T`` → the text, NULL text becomes ``''``; ``N`` → the decimal(18,5)
    rendering (``12.50000``), NULL when the number is NULL (such a fact writes
    nothing); any other value type → NULL (see :func:`writable_fact`).
    """
    return (F.when(valtype == VALTYPE_TEXT, F.coalesce(tval, F.lit("")))
             .when(valtype == VALTYPE_NUMERIC, nval.cast(DEC).cast("string")))


def writable_fact(valtype: Column, nval: Column) -> Column:
    """True for facts that write a cell: any ``T`` fact, an ``N`` fact with a number."""
    return (valtype == VALTYPE_TEXT) | ((valtype == VALTYPE_NUMERIC) & nval.isNotNull())


def valid_valtype(valtype: Column) -> Column:
    return valtype.isin(VALTYPE_NUMERIC, VALTYPE_TEXT)


def split_code_parts(code: Column, sep: str = "_") -> Column:
    """Array of the parts of a ``<patient>_<visit>`` subject code."""
    return F.split(code, sep, -1)


def split_subjectcode(df: DataFrame, code_col: str | None = None, sep: str = "_",
                      mode: str = "strict", patient_col: str = "PATIENT_ID",
                      visit_col: str = "VISIT_ID") -> DataFrame:
    """Prepend PATIENT_ID and VISIT_ID split from the code column (default: first column).

    Exactly one separator is required.  ``strict`` fails the task on a bad
    code; ``lenient`` drops such rows (see :func:`split_rejects`).
    """
    code_col = code_col or df.columns[0]
    parts = split_code_parts(qcol(code_col), sep)
    ok = F.size(parts) == 2
    if mode == "strict":
        parts = F.when(ok, parts).otherwise(F.raise_error(
            F.concat(F.lit("subject code needs exactly one '" + sep + "': "),
                     F.coalesce(qcol(code_col), F.lit("NULL")))).cast("array<string>"))
    elif mode != "lenient":
        raise ValueError(f"unknown mode {mode!r}")
    out = df.withColumn("__parts", parts)
    if mode == "lenient":
        out = out.filter(F.size("__parts") == 2)
    return out.select(F.col("__parts")[0].alias(patient_col), F.col("__parts")[1].alias(visit_col),
                      *[qcol(c) for c in df.columns])


def split_rejects(df: DataFrame, code_col: str | None = None, sep: str = "_") -> DataFrame:
    code_col = code_col or df.columns[0]
    return df.filter(~(F.size(split_code_parts(qcol(code_col), sep)) == 2)
                     | qcol(code_col).isNull())


def set_or_append(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column: replaced in place when the name exists, else appended last.

    The match is exact.  Under a case-insensitive session a column differing
    only by case would be silently replaced, so that case is refused.
    """
    if name in df.columns:
        return df.select(*[(F.lit(value).alias(c) if c == name else qcol(c)) for c in df.columns])
    clash = [c for c in df.columns if c.lower() == name.lower()]
    if clash and not is_case_sensitive(df.sparkSession):
        raise ValueError(f"column {name!r} differs only by case from {clash}; "
                         "set spark.sql.caseSensitive=true to keep both")
    return df.select(*[qcol(c) for c in df.columns], F.lit(value).alias(name))
