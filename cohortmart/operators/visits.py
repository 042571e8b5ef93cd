"""Visit selection: first/last visits, first MRI, valid diagnosis, band and nearest joins.

Every "arg-min per patient" here is a grouped ``min``/``max`` over a struct
whose leading field is the ordering value; the aggregate is partial (combined
map-side before the shuffle), so one patient holding a large share of all
visits does not land in one task, and no window sort over a hot patient is
needed.  Ties are broken by the following struct fields, which makes every
choice deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values (concept codes and texts used by the 6-months export) ---
DIAGNOSIS_CONCEPT = "DIAG_etiology_1"
PENDING_DIAGNOSIS_PATTERN = "Diagnostic en%"
MMSE_CONCEPT = "minimentalstate"
MOCA_CONCEPT = "montrealcognitiveassessment"
MRI_LOCATION = "MRI"
# The reference divides epoch seconds by 3600*4 and compares with 180, i.e.
# 180 units of four hours = 30 days.
AS_CODED_WINDOW_SECONDS = 180 * 3600 * 4
DEFAULT_WINDOW_SECONDS = 180 * 86400
# --------------------------------------------------------------------------


def seconds_between(a, b):
    """Signed ``b - a`` in whole seconds, for timestamp or timestamp_ntz columns."""
    return F.timestamp_diff("SECOND", a, b)


def visits_at_extreme(visits: DataFrame, which: str = "min") -> DataFrame:
    """All visits of a patient that fall on the patient's first (``min``) or last
    (``max``) date; ties are kept.  Grouped aggregate + equi-join on
    (patient_num, start_date): the join key includes the date, so a patient with
    very many visits spreads over many partitions."""
    agg = F.min if which == "min" else F.max
    if which not in ("min", "max"):
        raise ValueError("which must be 'min' or 'max'")
    edge = (visits.groupBy("patient_num")
            .agg(agg("start_date").alias("start_date")))
    return visits.join(edge, ["patient_num", "start_date"], "inner")


def first_mri(visits: DataFrame, location: str = MRI_LOCATION) -> DataFrame:
    """Per patient: date of the first visit at ``location`` and its encounter
    (lowest encounter_num when several share that date)."""
    first = (visits.filter(F.col("location_cd") == location)
             .groupBy("patient_num")
             .agg(F.min(F.struct("start_date", "encounter_num")).alias("m")))
    return first.select("patient_num", F.col("m.start_date").alias("mri_date"),
                        F.col("m.encounter_num").alias("encounter_num_mri"))


def valid_diagnosis_encounters(facts: DataFrame, concept: str = DIAGNOSIS_CONCEPT,
                               pending_pattern: str = PENDING_DIAGNOSIS_PATTERN,
                               exclude_values: Sequence[str] = ("NA",)) -> DataFrame:
    """Encounters holding a usable diagnosis text (case-sensitive LIKE, as coded)."""
    cond = ((F.col("concept_cd") == concept) & F.col("tval_char").isNotNull()
            & ~F.col("tval_char").like(pending_pattern))
    if exclude_values:
        cond = cond & ~F.col("tval_char").isin(*exclude_values)
    return facts.filter(cond).select("encounter_num").distinct()


def diagnosis_candidates(visits: DataFrame, mri: DataFrame, valid_encounters: DataFrame,
                         window_seconds: int) -> DataFrame:
    """Band join: visits of the same patient within ``window_seconds`` of the first
    MRI, other than the MRI encounter, holding a valid diagnosis.

    Equi-join on patient_num with a residual time predicate (never a cross or
    nested-loop join), then a left-semi join on encounter_num.
    """
    v = visits.select("patient_num", "encounter_num", "start_date", "patient_age")
    cand = (v.join(mri, "patient_num", "inner")
            .withColumn("abs_dt", F.abs(seconds_between(F.col("mri_date"), F.col("start_date"))))
            .filter((F.col("abs_dt") <= F.lit(window_seconds))
                    & (F.col("encounter_num") != F.col("encounter_num_mri"))))
    return cand.join(valid_encounters, "encounter_num", "left_semi")


def nearest_diagnosis(candidates: DataFrame, pick: str = "closest") -> DataFrame:
    """One diagnosis visit per patient: closest (or farthest) from the MRI, then the
    lowest encounter_num."""
    if pick == "closest":
        order = F.col("abs_dt")
    elif pick == "farthest":
        order = -F.col("abs_dt")
    else:
        raise ValueError("pick must be 'closest' or 'farthest'")
    best = (candidates
            .groupBy("patient_num")
            .agg(F.min(F.struct(order.alias("o"), F.col("encounter_num"), F.col("start_date"),
                                F.col("patient_age"), F.col("mri_date"),
                                F.col("encounter_num_mri"))).alias("b")))
    return best.select("patient_num", F.col("b.mri_date").alias("mri_date"),
                       F.col("b.encounter_num_mri").alias("encounter_num_mri"),
                       F.col("b.start_date").alias("diag_date"),
                       F.col("b.encounter_num").alias("encounter_num_diag"),
                       F.col("b.patient_age").alias("age_diag"))


def cognitive_visits(facts: DataFrame, diag: DataFrame, window_seconds: int,
                     concepts: Sequence[tuple[str, str]] = (("encounter_num_mmse", MMSE_CONCEPT),
                                                            ("encounter_num_moca", MOCA_CONCEPT))
                     ) -> DataFrame:
    """Attach, per patient, the encounter holding each concept closest in time to
    the diagnosis date (within the window; then lowest encounter_num).  Left join:
    patients without such a test keep NULL."""
    names = [c for _, c in concepts]
    tests = (facts.filter(F.col("concept_cd").isin(*names))
             .select("patient_num", "encounter_num", F.col("start_date").alias("test_date"),
                     "concept_cd"))
    near = (tests.join(diag.select("patient_num", "diag_date"), "patient_num", "inner")
            .withColumn("abs_dt", F.abs(seconds_between(F.col("diag_date"), F.col("test_date"))))
            .filter(F.col("abs_dt") <= F.lit(window_seconds)))
    aggs = [F.min(F.when(F.col("concept_cd") == concept,
                         F.struct("abs_dt", "encounter_num"))).alias(out)
            for out, concept in concepts]
    best = near.groupBy("patient_num").agg(*aggs)
    best = best.select("patient_num", *[F.col(f"{out}.encounter_num").alias(out)
                                        for out, _ in concepts])
    return diag.join(best, "patient_num", "left")


def stack_encounters(selection: DataFrame, roles: Sequence[str]) -> DataFrame:
    """(patient_num, encounter_num, role_rank) from several encounter columns.

    Replaces the disjunctive ``enc = a OR enc = b OR …`` join with a long table
    and an equi-join; an encounter filling several roles keeps its best rank.
    """
    stacked = selection.select(
        "patient_num",
        F.inline(F.array(*[F.struct(F.lit(i + 1).alias("role_rank"),
                                    F.col(r).alias("encounter_num"))
                           for i, r in enumerate(roles)])))
    return (stacked.filter(F.col("encounter_num").isNotNull())
            .groupBy("patient_num", "encounter_num")
            .agg(F.min("role_rank").alias("role_rank")))
