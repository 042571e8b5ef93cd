"""Imaging ingest: wide volumes batch + visit list → star tables of the capture mart.

Steps (each a DataFrame operator): split the subject code into PATIENT_ID and
VISIT_ID, melt the measure columns to (Attribute, Value), assign patient and
encounter numbers (known natural keys keep their numbers), and run the
imaging ``MappingSpec`` that fills encounter_mapping, visit_dimension,
patient_mapping and observation_fact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmart.functions.columns import DEC, split_subjectcode
from cohortmart.operators.identity import assign_encounter_num, assign_patient_num
from cohortmart.operators.quality import key_violations
from cohortmart.operators.reshape import UnpivotSpec, unpivot
from cohortmart.plans.mapping import (
    Const, Copy, Expr, Join, LoadTime, MappingSpec, Sequence_, Target, run_mapping)

# --- fixed values of the imaging mapping ----------------------------------
VISIT_DATE_FORMAT = "dd/MM/yyyy"
IMAGING_LOCATION = "MRI"
NUMERIC_VALTYPE = "N"
NUMERIC_TVAL = "E"
NO_MODIFIER = "@"
ID_COLUMNS = ("PATIENT_ID", "VISIT_ID")
# --------------------------------------------------------------------------


def parse_visit_date(col: Column, mode: str = "strict") -> Column:
    """``dd/MM/yyyy`` text → timestamp_ntz.  ``strict`` fails on bad text (ANSI),
    ``lenient`` gives NULL."""
    if mode == "strict":
        d = F.to_date(col, VISIT_DATE_FORMAT)
    elif mode == "lenient":
        d = F.try_to_date(col, VISIT_DATE_FORMAT)
    else:
        raise ValueError("mode must be 'strict' or 'lenient'")
    return d.cast("timestamp_ntz")


#: A total order of the loaded facts, for reproducible ``newId`` numbers.
FACT_ORDER = ("encounter_num", "concept_cd", "nval_num", "patient_num")


def imaging_spec(date_mode: str = "strict", fact_order: Sequence[str] = (), fact_offset: int = 0,
                 bucket: Callable[[Column], Column] | None = None, fact_ranges: int | None = None,
                 new_maps_unique: bool = False, visits_unique: bool = False) -> MappingSpec:
    """The imaging capture mapping: 8 source aliases, 5 joins, 4 targets.

    The two identity maps deliver only the rows that this load adds (the
    tables are appended to); visits and facts resolve against the full maps.
    ``fact_order``: columns that ``text_search_index`` follows; without any it
    numbers the facts as they are stored, in one materialisation and without a
    shuffle.  ``fact_offset``: the greatest number of earlier loads.
    ``bucket``: every target gets a column ``bucket``, this of the patient code.
    ``fact_ranges``: into how many ranges of ``fact_order`` the facts are dealt.
    ``new_maps_unique``: the new rows of the identity maps have no key twice;
    ``visits_unique``: nor have the visits, and their codes no second number.
    What is known to be unique is not shuffled to be made distinct.
    """
    def vdate(alias):
        return Expr((alias,), lambda c: parse_visit_date(c(alias, "VISIT_DATE"), date_mode))

    def bucketed(alias):
        return () if bucket is None else (("bucket", Expr((alias,), lambda c: bucket(c(alias, "patient_ide")))),)

    return MappingSpec(
        sources={"mv": "mri_visits", "em": "EncounterMapping", "pm": "PatientMapping",
                 "pm1": "PatientMappingNew", "uv": "unpivoted_volumes", "mv1": "mri_visits",
                 "em1": "EncounterMapping", "pm2": "PatientMapping",
                 "emn": "EncounterMappingNew", "mvn": "visit_keys", "pmn": "PatientMapping"},
        joins=(
            Join(("em", "encounter_ide"), ("mv", "VISIT_ID")),
            Join(("em", "patient_ide"), ("pm", "patient_ide")),
            Join(("emn", "encounter_ide"), ("mvn", "VISIT_ID")),
            Join(("emn", "patient_ide"), ("pmn", "patient_ide")),
            Join(("uv", "VISIT_ID"), ("mv1", "VISIT_ID")),
            Join(("uv", "VISIT_ID"), ("em1", "encounter_ide")),
            Join(("em1", "patient_ide"), ("pm2", "patient_ide")),
        ),
        targets=(
            Target("encounter_mapping", (
                ("encounter_ide", Copy("emn", "encounter_ide")),
                ("encounter_ide_source", Copy("emn", "encounter_ide_source")),
                ("project_id", Copy("emn", "project_id")),
                ("patient_ide", Copy("emn", "patient_ide")),
                ("patient_ide_source", Copy("emn", "patient_ide_source")),
                ("encounter_num", Copy("emn", "encounter_num")),
                ("import_date", LoadTime()),
                *bucketed("emn"),
            ), distinct=not new_maps_unique),
            Target("visit_dimension", (
                ("encounter_num", Copy("em", "encounter_num")),
                ("patient_num", Copy("pm", "patient_num")),
                ("start_date", vdate("mv")),
                ("patient_age", Expr(("mv",), lambda c: c("mv", "PATIENT_AGE").cast(DEC))),
                ("location_cd", Const(IMAGING_LOCATION)),
                ("import_date", LoadTime()),
                *bucketed("pm"),
            ), distinct=not visits_unique),
            Target("patient_mapping", (
                ("patient_ide", Copy("pm1", "patient_ide")),
                ("patient_ide_source", Copy("pm1", "patient_ide_source")),
                ("project_id", Copy("pm1", "project_id")),
                ("patient_num", Copy("pm1", "patient_num")),
                ("import_date", LoadTime()),
                *bucketed("pm1"),
            ), distinct=not new_maps_unique),
            Target("observation_fact", (
                *bucketed("pm2"),
                ("encounter_num", Copy("em1", "encounter_num")),
                ("patient_num", Copy("pm2", "patient_num")),
                ("concept_cd", Copy("uv", "Attribute")),
                ("provider_id", Copy("em1", "project_id")),
                ("start_date", vdate("mv1")),
                ("modifier_cd", Const(NO_MODIFIER)),
                ("instance_num", Const(1, "int")),
                ("valtype_cd", Const(NUMERIC_VALTYPE)),
                ("tval_char", Const(NUMERIC_TVAL)),
                ("nval_num", Expr(("uv",), lambda c: c("uv", "Value").cast(DEC))),
                ("text_search_index", Sequence_(tuple(fact_order), fact_offset, fact_ranges)),
                ("location_cd", Const(IMAGING_LOCATION)),
                ("import_date", LoadTime()),
            ), driver="uv"),
        ),
    )


@dataclass(frozen=True)
class IngestResult:
    volumes_df: DataFrame
    unpivoted: DataFrame
    patient_mapping_new: DataFrame
    patient_mapping: DataFrame
    encounter_mapping_new: DataFrame
    encounter_mapping: DataFrame
    targets: Mapping[str, DataFrame]
    duplicate_visit_ids: DataFrame   # the mapping joins on VISIT_ID alone: must be empty
    rejects: DataFrame               # (PATIENT_ID, VISIT_ID, reason) of rows that are not loaded


def load_rejects(volumes_df: DataFrame, visits: DataFrame) -> DataFrame:
    """Visits without a key part, and scans whose visit is not listed."""
    keyless = visits.filter("PATIENT_ID is null or VISIT_ID is null").select(
        "PATIENT_ID", "VISIT_ID", F.lit("visit without a key").alias("reason"))
    listed = visits.filter("PATIENT_ID is not null").select("VISIT_ID").distinct()
    unlisted = (volumes_df.select("PATIENT_ID", "VISIT_ID").join(listed, "VISIT_ID", "left_anti")
                .select("PATIENT_ID", "VISIT_ID", F.lit("scan without a visit").alias("reason")))
    return keyless.unionByName(unlisted)


def _enforce(visits: DataFrame) -> None:
    """One aggregate over the visits: no NULL key part, no repeated VISIT_ID."""
    per = visits.groupBy("VISIT_ID").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("PATIENT_ID").isNull().cast("int")).alias("keyless"))
    worst = per.agg(F.max("n").alias("n"), F.max((F.col("VISIT_ID").isNull() | (F.col("keyless") > 0)).cast("int")).alias("keyless")).first()
    if worst.keyless:
        raise ValueError("a visit has no PATIENT_ID or VISIT_ID; policy='report' loads the others")
    if (worst.n or 0) > 1:
        raise ValueError("a VISIT_ID is listed twice; the mapping joins on it alone (policy='report' loads it)")


def ingest_imaging(volumes: DataFrame, mri_visits: DataFrame, measures: Sequence[str] | None = None,
                   hospital: str = "MockHospital",
                   existing_patients: DataFrame | None = None,
                   existing_encounters: DataFrame | None = None,
                   load_time: Column | None = None, split_mode: str = "strict",
                   date_mode: str = "strict", policy: str = "fail", fact_order: Sequence[str] = (),
                   fact_offset: int = 0) -> IngestResult:
    """Run the imaging pipeline.  ``measures`` defaults to every column after the
    subject code (135 brain volumes as a rule).  ``policy``: ``fail`` stops on a
    visit without a key or a repeated VISIT_ID, ``report`` only lists them."""
    if policy == "fail":
        _enforce(mri_visits)
    elif policy != "report":
        raise ValueError("policy must be 'fail' or 'report'")
    volumes_df = split_subjectcode(volumes, mode=split_mode)
    values = list(measures) if measures is not None else [
        c for c in volumes.columns[1:] if c not in ID_COLUMNS]
    cells = UnpivotSpec(volumes_df, ids=ID_COLUMNS, values=values, value_type="decimal(18,5)")
    unpivoted = unpivot(cells)
    pm_new, pm_full = assign_patient_num(mri_visits, existing_patients, hospital, hospital)
    em_new, em_full = assign_encounter_num(mri_visits, existing_encounters, hospital, hospital)
    visits = mri_visits if "PATIENT_AGE" in mri_visits.columns else mri_visits.withColumn(
        "PATIENT_AGE", F.lit(None).cast(DEC))
    tables = {"mri_visits": visits, "EncounterMapping": em_full, "PatientMapping": pm_full,
              "EncounterMappingNew": em_new, "PatientMappingNew": pm_new,
              "visit_keys": visits.select("VISIT_ID").distinct(), "unpivoted_volumes": cells}
    targets = run_mapping(imaging_spec(date_mode, fact_order, fact_offset), tables, load_time)
    dup = key_violations(visits, ["VISIT_ID"])
    return IngestResult(volumes_df, unpivoted, pm_new, pm_full, em_new, em_full, targets, dup,
                        load_rejects(volumes_df, visits))
