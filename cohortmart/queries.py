"""

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame that
reads the whole driver tables through the clinical view
(:mod:`cohortmart.fixtures`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortmart.fixtures import clinical_mart, wide_mart
from cohortmart.plans import export as X

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- exports --

@register("export_mindate")
def export_mindate(spark, sf_dir):
    """One row per patient code, facts of the first-date visits."""
    return X.export_frame(clinical_mart(spark, sf_dir), "mindate")


@register("export_maxdate")
def export_maxdate(spark, sf_dir):
    """Same for the last date."""
    return X.export_frame(clinical_mart(spark, sf_dir), "maxdate")


@register("export_longitude")
def export_longitude(spark, sf_dir):
    """One row per (patient code, visit code)."""
    return X.export_frame(clinical_mart(spark, sf_dir), "longitude")


@register("export_6months")
def export_6months(spark, sf_dir):
    """O36 with the documented defaults: 180 days, closest diagnosis, NA excluded."""
    return X.export_frame(clinical_mart(spark, sf_dir), "6months", X.DEFAULT)


@register("export_6months_as_coded")
def export_6months_as_coded(spark, sf_dir):
    """O36 as the reference scripts compute it: 30 days, farthest diagnosis, NA kept."""
    return X.export_frame(clinical_mart(spark, sf_dir), "6months", X.AS_CODED)


# ------------------------------------------------------- column operators --

from pyspark.sql import functions as F  # noqa: E402

from cohortmart.fixtures import (  # noqa: E402
    HOSPITAL, LINEITEM_IDS, LINEITEM_MEASURES, imaging_batch, lineitem_measures, read_table)
from cohortmart.functions import columns as C  # noqa: E402
from cohortmart.operators import anonymize as A  # noqa: E402
from cohortmart.operators import identity as I  # noqa: E402
from cohortmart.operators import quality as QC  # noqa: E402
from cohortmart.operators import reshape as R  # noqa: E402
from cohortmart.operators import visits as V  # noqa: E402
from cohortmart.plans import ingest as G  # noqa: E402
from cohortmart.sources import files as FS  # noqa: E402
from cohortmart.session import scratch_path  # noqa: E402

# Fixed load timestamp for reproducible mapping outputs (``datetime()`` is
# injectable; production runs use the query's current timestamp).
LOAD_TIME_SQL = "TIMESTAMP_NTZ '2020-01-01 00:00:00'"
# Two incremental imaging loads: visits before this date, then all visits.
FIRST_LOAD_BEFORE = "1998-01-01"


@register("age_parts")
def age_parts(spark, sf_dir):
    """Whole years and months (0…12, HALF_UP) of every visit age."""
    vd = clinical_mart(spark, sf_dir).visit_dimension
    return vd.select("encounter_num", "patient_age",
                     C.age_years(F.col("patient_age")).alias("age_years"),
                     C.age_months(F.col("patient_age")).cast("long").alias("age_months"))


@register("age_group")
def age_group(spark, sf_dir):
    """Age band of every visit (first matching band wins)."""
    vd = clinical_mart(spark, sf_dir).visit_dimension
    return vd.select("encounter_num",
                     C.age_group(C.age_years(F.col("patient_age"))).alias("agegroup"))


@register("typed_value")
def typed_value(spark, sf_dir):
    """Rendered cell value of every writable fact (N NULLs write nothing)."""
    f = clinical_mart(spark, sf_dir).observation_fact
    return (f.filter(C.writable_fact(F.col("valtype_cd"), F.col("nval_num")))
            .select("encounter_num", "concept_cd", "instance_num",
                    C.typed_value(F.col("valtype_cd"), F.col("tval_char"),
                                  F.col("nval_num")).alias("value")))


@register("cde_columns")
def cde_columns(spark, sf_dir):
    """CDE columns in upload order with the number of facts of each."""
    m = clinical_mart(spark, sf_dir)
    counts = m.observation_fact.groupBy("concept_cd").agg(F.count(F.lit(1)).alias("n_facts"))
    return (R.cde_frame(m.concept_dimension).join(counts, "concept_cd", "left")
            .select("concept_cd", "upload_id",
                    F.coalesce(F.col("n_facts"), F.lit(0)).alias("n_facts")))


@register("cde_dictionary")
def cde_dictionary(spark, sf_dir):
    """The CDEs of a dictionary derived from the part table, in upload order."""
    k = F.col("p_partkey")
    parts = read_table(spark, sf_dir, "part").select(
        F.col("p_name").alias("concept_cd"), F.when(k % 3 == 0, F.lit("CDE")).when(k % 3 == 1, F.lit("LOCAL")).alias("sourcesystem_cd"),
        (F.lit(1_000_000) - k).cast("int").alias("upload_id"))
    return R.cde_frame(parts)


@register("concept_catalog_mixed")
def concept_catalog_mixed(spark, sf_dir):
    """The catalog of facts in which some concepts hold text and numbers."""
    vt = F.when((F.col("encounter_num") % 5 == 0) & F.col("concept_cd").isin("priority", "quantity"), F.lit("T")).otherwise(F.col("valtype_cd"))
    return R.concept_catalog(clinical_mart(spark, sf_dir).observation_fact.withColumn("valtype_cd", vt))


@register("concept_catalog")
def concept_catalog(spark, sf_dir):
    """One row per concept with its value type and a mixed-type flag."""
    return R.concept_catalog(clinical_mart(spark, sf_dir).observation_fact)


@register("dataset_constant")
def dataset_constant(spark, sf_dir):
    """The dataset value written into every export row, of a fact table with
    several providers (some NULL)."""
    k = F.col("encounter_num")
    f = clinical_mart(spark, sf_dir).observation_fact.withColumn(
        "provider_id", F.when(k % 7 > 0, F.concat("provider_id", F.lit("_"), (7 - k % 7).cast("string"))))
    return f.groupBy("concept_cd").agg(F.min("provider_id").alias("dataset"), F.count_distinct("provider_id").alias("providers"))


# -------------------------------------------------------- visit operators --

def _visits(m):
    return m.visit_dimension.select("patient_num", "encounter_num", "start_date", "patient_age",
                                    "location_cd")


@register("first_visits")
def first_visits(spark, sf_dir):
    """Visits on each patient's first date with the patient code (ties kept)."""
    m = clinical_mart(spark, sf_dir)
    return (V.visits_at_extreme(_visits(m), "min").join(m.patient_mapping, "patient_num")
            .select("patient_num", "patient_ide", "encounter_num", "start_date", "patient_age"))


@register("last_visits")
def last_visits(spark, sf_dir):
    """Visits on each patient's last date."""
    m = clinical_mart(spark, sf_dir)
    return (V.visits_at_extreme(_visits(m), "max").join(m.patient_mapping, "patient_num")
            .select("patient_num", "patient_ide", "encounter_num", "start_date", "patient_age"))


@register("first_mri")
def first_mri(spark, sf_dir):
    """First MRI date and encounter per patient."""
    return V.first_mri(_visits(clinical_mart(spark, sf_dir)))


@register("valid_diagnosis")
def valid_diagnosis(spark, sf_dir):
    """Visits holding a valid diagnosis (left-semi join)."""
    m = clinical_mart(spark, sf_dir)
    valid = V.valid_diagnosis_encounters(m.observation_fact)
    return (m.visit_dimension.join(valid, "encounter_num", "left_semi")
            .select("encounter_num", "patient_num", "start_date"))


def _six(spark, sf_dir, opts=X.DEFAULT):
    m = clinical_mart(spark, sf_dir)
    visits = _visits(m)
    mri = V.first_mri(visits)
    valid = V.valid_diagnosis_encounters(m.observation_fact, exclude_values=opts.exclude_diagnoses)
    return m, visits, mri, valid


@register("mri_diag_candidates")
def mri_diag_candidates(spark, sf_dir):
    """Band join — valid diagnosis visits within 180 days of the first MRI."""
    m, visits, mri, valid = _six(spark, sf_dir)
    return (V.diagnosis_candidates(visits, mri, valid, V.DEFAULT_WINDOW_SECONDS)
            .select("patient_num", "encounter_num", "encounter_num_mri", "abs_dt"))


@register("mri_nearest_diag")
def mri_nearest_diag(spark, sf_dir):
    """The closest valid diagnosis per patient."""
    m, visits, mri, valid = _six(spark, sf_dir)
    return V.nearest_diagnosis(V.diagnosis_candidates(visits, mri, valid,
                                                      V.DEFAULT_WINDOW_SECONDS), "closest")


@register("diag_cognitive_visits")
def diag_cognitive_visits(spark, sf_dir):
    """MMSE / MoCA visits nearest the chosen diagnosis (left join)."""
    return X.six_month_selection(clinical_mart(spark, sf_dir), X.DEFAULT)


@register("pivot_observations")
def pivot_observations(spark, sf_dir):
    """EAV → wide per encounter; winner = greatest (instance, value)."""
    m = clinical_mart(spark, sf_dir)
    f = m.observation_fact.filter(C.writable_fact(F.col("valtype_cd"), F.col("nval_num")))
    v = C.typed_value(F.col("valtype_cd"), F.col("tval_char"), F.col("nval_num"))
    cells = f.select("encounter_num", "concept_cd", R.winner_struct(
        F.col("instance_num"), F.when(F.col("valtype_cd") == "N", F.col("nval_num")),
        value=v).alias("w"))
    concepts = sorted(R.Catalog.collect(m.observation_fact).valtypes)
    return R.pivot_cells(R.winning_cells(cells, ["encounter_num"]), ["encounter_num"], concepts)


# ---------------------------------------------------------------- reshape --

@register("unpivot_measures")
def unpivot_measures(spark, sf_dir):
    """Melt the lineitem measures to (Attribute, Value), NULLs kept."""
    return R.unpivot(R.UnpivotSpec(lineitem_measures(spark, sf_dir), ids=LINEITEM_IDS,
                                   values=LINEITEM_MEASURES))


@register("unpivot_many")
def unpivot_many(spark, sf_dir):
    """Two wide tables melted and appended by name (missing id → NULL)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return R.unpivot_many([
        R.UnpivotSpec(lineitem_measures(spark, sf_dir), ids=LINEITEM_IDS, values=LINEITEM_MEASURES,
                      id_aliases={"l_orderkey": "entity_id", "l_linenumber": "line_no"}),
        R.UnpivotSpec(orders, ids=("o_orderkey",), values=("o_totalprice",),
                      id_aliases={"o_orderkey": "entity_id"}),
    ])


@register("split_subjectcode")
def split_subjectcode(spark, sf_dir):
    """PATIENT_ID and VISIT_ID split from the subject code of each scan."""
    return C.split_subjectcode(imaging_batch(spark, sf_dir)["volumes"])


# --------------------------------------------------------------- identity --

def _two_loads(spark, sf_dir):
    visits = imaging_batch(spark, sf_dir)["mri_visits"]
    early = visits.filter(G.parse_visit_date(F.col("VISIT_DATE"))
                          < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    _, first = I.assign_patient_num(early, None, HOSPITAL, HOSPITAL)
    return I.assign_patient_num(visits, first, HOSPITAL, HOSPITAL)


@register("assign_patient_num")
def assign_patient_num(spark, sf_dir):
    """Patient numbers after two loads (known ids reused, new ones appended)."""
    return _two_loads(spark, sf_dir)[1]


@register("new_patient_ids")
def new_patient_ids(spark, sf_dir):
    """Patients of the second load not yet mapped (left-anti join), numbered."""
    return _two_loads(spark, sf_dir)[0]


@register("assign_encounter_num")
def assign_encounter_num(spark, sf_dir):
    """Encounter numbers for every visit code."""
    visits = imaging_batch(spark, sf_dir)["mri_visits"]
    return I.assign_encounter_num(visits, None, HOSPITAL, HOSPITAL)[1]


# ---------------------------------------------------------------- mapping --

def _ingest(spark, sf_dir):
    b = imaging_batch(spark, sf_dir)
    return G.ingest_imaging(b["volumes"], b["mri_visits"], measures=LINEITEM_MEASURES,
                            hospital=HOSPITAL, load_time=F.expr(LOAD_TIME_SQL), fact_order=G.FACT_ORDER)


@register("map_encounter_mapping")
def map_encounter_mapping(spark, sf_dir):
    """Imaging mapping → encounter_mapping."""
    return _ingest(spark, sf_dir).targets["encounter_mapping"]


@register("map_visit_dimension")
def map_visit_dimension(spark, sf_dir):
    """Imaging mapping → visit_dimension (3-way join)."""
    return _ingest(spark, sf_dir).targets["visit_dimension"]


@register("map_patient_mapping")
def map_patient_mapping(spark, sf_dir):
    """Imaging mapping → patient_mapping."""
    return _ingest(spark, sf_dir).targets["patient_mapping"]


@register("map_observation_fact")
def map_observation_fact(spark, sf_dir):
    """Imaging mapping → observation_fact (4-way join, constants, newId)."""
    return _ingest(spark, sf_dir).targets["observation_fact"]


def _second_load(spark, sf_dir):
    """The targets of a first load (early visits) and of a second (all visits)."""
    b = imaging_batch(spark, sf_dir)
    early = b["mri_visits"].filter(G.parse_visit_date(F.col("VISIT_DATE")) < F.lit(FIRST_LOAD_BEFORE).cast("timestamp_ntz"))
    first = G.ingest_imaging(b["volumes"], early, LINEITEM_MEASURES, HOSPITAL, load_time=F.expr(LOAD_TIME_SQL))
    second = G.ingest_imaging(b["volumes"], b["mri_visits"], LINEITEM_MEASURES, HOSPITAL, first.patient_mapping,
                              first.encounter_mapping, load_time=F.expr(LOAD_TIME_SQL))
    return first.targets, second.targets


@register("map_second_load_patients")
def map_second_load_patients(spark, sf_dir):
    """patient_mapping after two loads appended; no patient twice."""
    first, second = _second_load(spark, sf_dir)
    return first["patient_mapping"].unionByName(second["patient_mapping"])


@register("map_second_load_encounters")
def map_second_load_encounters(spark, sf_dir):
    """encounter_mapping after two loads appended; no visit twice."""
    first, second = _second_load(spark, sf_dir)
    return first["encounter_mapping"].unionByName(second["encounter_mapping"])


@register("ingest_rejects")
def ingest_rejects(spark, sf_dir):
    """Rows that a load leaves out (here every tenth visit lost its patient)."""
    b = imaging_batch(spark, sf_dir)
    k = F.substring("VISIT_ID", 2, 20).cast("long")
    visits = b["mri_visits"].withColumn("PATIENT_ID", F.when(k % 10 > 0, F.col("PATIENT_ID")))
    return G.ingest_imaging(b["volumes"], visits, LINEITEM_MEASURES, HOSPITAL, policy="report").rejects


@register("harmonize_visits")
def harmonize_visits(spark, sf_dir):
    """Mart to mart mapping with a selection and a bridge table."""
    from cohortmart.plans.jobs import harmonize
    from cohortmart.plans.mapping import Const, Copy, Join, MappingSpec, Target
    spec = MappingSpec(
        sources={"pm": "patient_mapping", "em": "encounter_mapping", "vd": "visit_dimension"},
        joins=(Join(("pm", "patient_ide"), ("em", "patient_ide")), Join(("em", "encounter_num"), ("vd", "encounter_num"))),
        targets=(Target("visit_dimension", (
            ("encounter_num", Copy("vd", "encounter_num")), ("patient_num", Copy("pm", "patient_num")),
            ("start_date", Copy("vd", "start_date")), ("patient_age", Copy("vd", "patient_age")),
            ("location_cd", Const("HARMONIZED"))), driver="vd"),),
        where=lambda c: c("vd", "location_cd") == "MRI", where_aliases=("vd",))
    return harmonize(clinical_mart(spark, sf_dir), spec).visit_dimension


@register("extract_csv_readback")
def extract_csv_readback(spark, sf_dir):
    """The CSV export job with its ``Dataset`` column, read back."""
    from cohortmart.plans.jobs import case_sensitive, extract_to_csv
    path = extract_to_csv({"harmonized": clinical_mart(spark, sf_dir)}, "maxdate", scratch_path(spark, "job"), dataset="CLM")
    with case_sensitive(spark):  # the file has both ``dataset`` and ``Dataset``
        back = FS.read_csv(spark, path, "subjectcode string, agegroup string, priority string, totalprice decimal(18,5), `Dataset` string")
        return back.checkpoint(eager=True)  # names are resolved while both can be told apart


@register("text_roundtrip")
def text_roundtrip(spark, sf_dir):
    """Padded, quoted and multi-line text through a CSV file and back."""
    text = F.concat(F.lit('  "'), F.col("text"), F.lit('", x\n  '))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return FS.read_csv(spark, FS.write_csv(docs, scratch_path(spark, "text")), docs.schema).select(
        "doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


# ---------------------------------------------------------- anonymization --

@register("text_roundtrip_single")
def text_roundtrip_single(spark, sf_dir):
    """The same text through one CSV file, put together from parallel parts."""
    text = F.concat(F.lit('  "'), F.col("text"), F.lit('", x\n  '))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return FS.read_csv(spark, FS.write_csv(docs, scratch_path(spark, "text"), single_file=True), docs.schema).select(
        "doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


@register("text_roundtrip_split")
def text_roundtrip_split(spark, sf_dir):
    """O1: the same text, its file cut at record ends found by quote parity."""
    text = F.concat(F.lit('  "'), F.col("text"), F.lit('", x\n  '))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    path = FS.write_csv(docs, scratch_path(spark, "text"), single_file=True)
    return FS.read_csv(spark, path, docs.schema, split_bytes=0).select(
        "doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


#: Files, each with a header of its own, that merge_volumes_mixed deals the scans to.
MIXED_FILES = 24


@register("merge_volumes_mixed")
def merge_volumes_mixed(spark, sf_dir):
    """Outputs with a header each and conflicting types, merged without a
    given schema: whole numbers and decimals become decimals, numbers and words
    text, and a column that one file alone has is NULL for the others."""
    volumes = imaging_batch(spark, sf_dir)["volumes"].withColumn("k", F.expr("cast(split_part(subjectcode, '_V', 2) as bigint) % 24")).checkpoint()
    root = scratch_path(spark, "mixed")
    for k in range(MIXED_FILES):
        quantity = F.col("l_quantity").cast("bigint" if k % 2 else "decimal(18,5)")
        FS.write_csv(volumes.filter(F.col("k") == k).select(
            "subjectcode", quantity.alias("l_quantity"), F.lit(str(k) if k % 3 else f"run{k}").alias("run"),
            F.col("l_tax").alias(f"tax_{k}")), f"{root}/{k}")
    merged = FS.merge_outputs(spark, [f"{root}/{k}" for k in range(MIXED_FILES)])
    return merged.select("subjectcode", "l_quantity", "run", F.coalesce(*(f"tax_{k}" for k in range(MIXED_FILES))).alias("l_tax"))


_JOB_COLUMNS = "subjectcode string, agegroup string, priority string, totalprice decimal(18,5), `Dataset` string"


def _appending_job(spark, sf_dir, anonymized_first):
    """Two export jobs into one file, the second with ``append``; between them a
    replacement of the file died with the old folder set aside."""
    from cohortmart.plans.jobs import case_sensitive, extract_to_csv
    from cohortmart.sources.storage import Files
    marts, out = {"harmonized": clinical_mart(spark, sf_dir)}, scratch_path(spark, "job")
    path = extract_to_csv(marts, "mindate", out, dataset="OLD", csv_name="x.csv", anonymized=anonymized_first, hash_method="md5")
    Files(spark).rename(path, f"{path}._old")
    extract_to_csv(marts, "maxdate", out, dataset="CLM", csv_name="x.csv", append=True)
    with case_sensitive(spark):
        return FS.read_csv(spark, path, _JOB_COLUMNS).checkpoint(eager=True)


@register("job_append_merged")
def job_append_merged(spark, sf_dir):
    """The previous export (with hashed codes here) stays beside the new one."""
    return _appending_job(spark, sf_dir, True)


@register("job_append_skipped")
def job_append_skipped(spark, sf_dir):
    """The previous export holds the same codes, so none of its rows stay."""
    return _appending_job(spark, sf_dir, False)


@register("anonymize_flat_md5")
def anonymize_flat_md5(spark, sf_dir):
    """First column of the mindate export replaced by its md5."""
    return A.anonymize_flat(export_mindate(spark, sf_dir), (0,), "md5")


@register("anonymize_flat_sha224")
def anonymize_flat_sha224(spark, sf_dir):
    """First column hashed with SHA-224."""
    return A.anonymize_flat(export_mindate(spark, sf_dir), (0,), "sha224")


@register("anonymize_flat_sha3")
def anonymize_flat_sha3(spark, sf_dir):
    """The flat-file ``sha224`` choice, i.e. SHA3-224 (Arrow UDF)."""
    from cohortmart.functions.hashing import flat_csv_method
    return A.anonymize_flat(export_mindate(spark, sf_dir), (0,), flat_csv_method("sha224"))


def _hash_profile(spark, sf_dir, method):
    """Rows, distinct digests, distinct keys, and whether all digests are 56
    lower-case hexadecimal digits."""
    keys = export_mindate(spark, sf_dir).select("subjectcode", F.col("subjectcode").alias("key"))
    h = F.col("subjectcode")
    return A.anonymize_flat(keys, (0,), method).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(h).alias("digests"),
        F.min(h.rlike("^[0-9a-f]{56}$").cast("int")).alias("well_formed"), F.count_distinct("key").alias("keys"))


@register("sha224_profile")
def sha224_profile(spark, sf_dir):
    """SHA-224 keeps keys apart and has its form."""
    return _hash_profile(spark, sf_dir, "sha224")


@register("sha3_profile")
def sha3_profile(spark, sf_dir):
    """The flat-file ``sha224`` choice, SHA3-224, keeps keys apart and has its form."""
    from cohortmart.functions.hashing import flat_csv_method
    return _hash_profile(spark, sf_dir, flat_csv_method("sha224"))


@register("anonymize_mart_md5")
def anonymize_mart_md5(spark, sf_dir):
    """Fact table of the md5-anonymized mart (ids hashed consistently)."""
    return A.anonymize_mart(clinical_mart(spark, sf_dir), "md5").observation_fact


@register("export_mindate_anon")
def export_mindate_anon(spark, sf_dir):
    """Mindate export with md5 ids (chosen on raw ids, hashed in the result)."""
    return X.export_frame(clinical_mart(spark, sf_dir), "mindate", X.with_options(X.DEFAULT, hash_ids="md5"))


@register("add_dataset_column")
def add_dataset_column(spark, sf_dir):
    """``Dataset`` constant appended to a table that lacks it."""
    return C.set_or_append(first_visits(spark, sf_dir), "Dataset", HOSPITAL)


# ---------------------------------------------------------- sinks, checks --

@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """Mindate export written as flat CSV and read back with its schema
    (NULL and '' both come back as NULL, as with the reference's files)."""
    df = export_mindate(spark, sf_dir)
    path = FS.write_csv(df, scratch_path(spark, "csv"))
    return FS.read_csv(spark, path, df.schema)


@register("batch_scan")
def batch_scan(spark, sf_dir):
    """O2: every file of one named batch folder, tagged with batch and file."""
    visits = imaging_batch(spark, sf_dir)["mri_visits"]
    root = scratch_path(spark, "batches")
    FS.write_csv(visits, f"{root}/batch_1")
    return FS.read_batch(spark, root, "batch_1", visits.schema, file_col=None)


@register("merge_volumes")
def merge_volumes(spark, sf_dir):
    """O3: per-part output files merged by column name; the columns of half the
    files stand in another order, and one is missing there."""
    vol = imaging_batch(spark, sf_dir)["volumes"]
    root, odd = scratch_path(spark, "volumes"), F.substring_index("subjectcode", "_V", -1).cast("long") % 2 == 1
    FS.write_csv(vol.filter(~odd), f"{root}/a")
    FS.write_csv(vol.filter(odd).select("l_tax", "l_discount", "subjectcode", "l_quantity"), f"{root}/b")
    return FS.merge_outputs(spark, f"{root}/*/*.csv", vol.schema)


def _two_exports(spark, sf_dir):
    """The mindate and the maxdate export of one mart, its facts counted once."""
    mart = clinical_mart(spark, sf_dir)
    catalog = R.Catalog.collect(mart.observation_fact)
    return [X.export(mart, s, catalog=catalog, observe=False) for s in ("mindate", "maxdate")]


@register("append_export_merged")
def append_export_merged(spark, sf_dir):
    """A previous export with other subjects is appended (its codes differ here)."""
    new, other = _two_exports(spark, sf_dir)
    renamed = other.frame.withColumn("subjectcode", F.concat(F.lit("old-"), "subjectcode"))
    prev = FS.read_csv(spark, FS.write_csv(renamed, scratch_path(spark, "prev")), new.frame.schema)
    return FS.append_export(new.frame, prev, ["subjectcode"], new.keys)


@register("append_export")
def append_export(spark, sf_dir):
    """A previous export is appended only if no key collides (here: skipped)."""
    new, other = _two_exports(spark, sf_dir)
    prev_path = FS.write_csv(other.frame, scratch_path(spark, "prev"))
    prev = FS.read_csv(spark, prev_path, new.frame.schema)
    return FS.append_export(new.frame, prev, ["subjectcode"], new.keys)


@register("export_counters")
def export_counters(spark, sf_dir):
    """CDE columns, inserted rows and written facts of the mindate export."""
    return X.export(clinical_mart(spark, sf_dir), "mindate").counters()


@register("key_violations")
def key_violations(spark, sf_dir):
    """Fact keys present more than once (repeated line numbers of an order)."""
    return QC.key_violations(clinical_mart(spark, sf_dir).observation_fact, QC.FACT_KEY)


@register("null_demographics")
def null_demographics(spark, sf_dir):
    """Subjects of the mindate selection with NULL age or gender (the sex of
    every ninth patient is unknown here)."""
    m = clinical_mart(spark, sf_dir)
    sex = F.when(F.col("patient_num") % 9 > 0, F.col("sex_cd"))
    sel = X.select_extreme(m.with_tables(patient_dimension=m.patient_dimension.withColumn("sex_cd", sex)), "min")
    return QC.null_demographics(sel.rows, sel.key_cols).distinct()


@register("bad_valtype")
def bad_valtype(spark, sf_dir):
    """Facts whose value type is neither N nor T (line facts of every 13th
    visit are typed D here, of every 17th not at all)."""
    k, line = F.col("encounter_num"), F.col("concept_cd") == "quantity"
    vt = F.when(line & (k % 13 == 0), F.lit("D")).when(~(line & (k % 17 == 0)), F.col("valtype_cd"))
    return QC.bad_valtype(clinical_mart(spark, sf_dir).observation_fact.withColumn("valtype_cd", vt))



@register("export_outcomes")
def export_outcomes(spark, sf_dir):
    """Accepted and rejected subjects of one mindate run, with the
    run's counters (here some sexes are unknown and some value types bad)."""
    from cohortmart.plans.jobs import export_outcomes as run
    m = clinical_mart(spark, sf_dir)
    sex = F.when(F.col("patient_num") % 9 > 0, F.col("sex_cd"))
    vt = F.when((F.col("concept_cd") == "quantity") & (F.col("encounter_num") % 13 == 0), F.lit("D")).otherwise(F.col("valtype_cd"))
    odd = m.with_tables(patient_dimension=m.patient_dimension.withColumn("sex_cd", sex),
                        observation_fact=m.observation_fact.withColumn("valtype_cd", vt))
    path = scratch_path(spark, "outcomes")
    found = run(odd, "mindate", path)
    return spark.read.parquet(path).select("subjectcode", "quantity", "outcome", *[F.lit(found[c]).cast("long").alias(c) for c in
                                           ("inserts", "rejected_subjects", "updates", "skipped_facts")])


# ------------------------------------------------- mart variants (O38, O39) --

@register("export_local_mindate")
def export_local_mindate(spark, sf_dir):
    """Mindate over the capture mart filled by the imaging ingest."""
    from cohortmart.fixtures import capture_mart
    return X.export_frame(capture_mart(spark, sf_dir, F.expr(LOAD_TIME_SQL)), "mindate")


@register("export_maxdate_anon")
def export_maxdate_anon(spark, sf_dir):
    """Maxdate with md5 ids."""
    return X.export_frame(clinical_mart(spark, sf_dir), "maxdate", X.with_options(X.DEFAULT, hash_ids="md5"))


@register("export_longitude_anon")
def export_longitude_anon(spark, sf_dir):
    """Longitude with md5 patient and visit ids."""
    return X.export_frame(clinical_mart(spark, sf_dir), "longitude", X.with_options(X.DEFAULT, hash_ids="md5"))


@register("export_6months_anon")
def export_6months_anon(spark, sf_dir):
    """6months with md5 ids and the fixed dataset value."""
    from cohortmart.plans.jobs import strategy_for
    s = strategy_for("6months", anonymized=True)
    return X.export_frame(clinical_mart(spark, sf_dir), "6months", X.with_options(s.options, hash_ids="md5"))


# ------------------------------------------------ imaging-width exports (O33) --

@register("export_mindate_wide")
def export_mindate_wide(spark, sf_dir):
    """Mindate with 140 measure concepts beside the CDEs and local concepts."""
    return X.export_frame(wide_mart(spark, sf_dir), "mindate")


@register("export_longitude_wide")
def export_longitude_wide(spark, sf_dir):
    """Longitude with 140 measure concepts."""
    return X.export_frame(wide_mart(spark, sf_dir), "longitude")


# ------------------------------------- capture-mart variants of O38 (--local) --

def _capture(spark, sf_dir):
    from cohortmart.fixtures import capture_mart
    return capture_mart(spark, sf_dir, F.expr(LOAD_TIME_SQL))


@register("export_local_maxdate")
def export_local_maxdate(spark, sf_dir):
    """Maxdate over the capture mart."""
    return X.export_frame(_capture(spark, sf_dir), "maxdate")


@register("export_local_longitude")
def export_local_longitude(spark, sf_dir):
    """Longitude over the capture mart."""
    return X.export_frame(_capture(spark, sf_dir), "longitude")


@register("export_local_6months")
def export_local_6months(spark, sf_dir):
    """6months over a capture mart that holds diagnoses and cognitive tests too."""
    from cohortmart.fixtures import capture_mart
    return X.export_frame(capture_mart(spark, sf_dir, F.expr(LOAD_TIME_SQL), clinical=True), "6months")


# ------------------------------------------------------------ stored marts --
from cohortmart import queries_stored  # noqa: E402,F401  (registers its queries)
