"""Clinical views of the driver tables (customer, orders, lineitem).

The driver ships TPC-H-like parquet tables; these functions read them lazily
and present them as the star tables of a mart, and as a wide imaging batch,
so every job runs over whole tables whose size grows with the scale factor.
The same views are written in SQL for the DuckDB oracle (``sql_oracle.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmart.schema import DEC, Mart
from cohortmart.session import scratch_path

# --- fixed values of the clinical view ------------------------------------
HOSPITAL = "MockHospital"
# CDE columns in upload order, then the local (non-CDE) concepts.
CDE_CONCEPTS = ("subjectageyears", "subjectage", "gender", "dataset", "agegroup",
                "DIAG_etiology_1", "minimentalstate", "montrealcognitiveassessment")
LOCAL_CONCEPTS = ("totalprice", "priority", "quantity")
# order status → diagnosis text
DIAGNOSIS_BY_STATUS = (("F", "Alzheimer"), ("O", "Diagnostic en attente"), ("P", "NA"))
MRI_PRIORITIES = ("1-URGENT", "2-HIGH")
# Measures of lineitem melted by the unpivot examples, with their id columns.
LINEITEM_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINEITEM_IDS = ("l_orderkey", "l_linenumber")
# --------------------------------------------------------------------------

AGE_SQL = "cast((4000 + (o_custkey % 55) * 100 + (o_orderkey % 100)) / 100.0 as decimal(18,5))"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _patient_mapping(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_name").alias("patient_ide"),
        F.lit(HOSPITAL).alias("patient_ide_source"),
        F.lit(HOSPITAL).alias("project_id"),
        F.col("c_custkey").alias("patient_num"))


def _patient_dimension(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("patient_num"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex_cd"))


def _encounter_mapping(orders: DataFrame, customer: DataFrame) -> DataFrame:
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .select(F.concat(F.lit("V"), F.col("o_orderkey").cast("string")).alias("encounter_ide"),
                    F.lit(HOSPITAL).alias("encounter_ide_source"),
                    F.lit(HOSPITAL).alias("project_id"),
                    F.col("c_name").alias("patient_ide"),
                    F.lit(HOSPITAL).alias("patient_ide_source"),
                    F.col("o_orderkey").alias("encounter_num")))


def _visit_dimension(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("encounter_num"),
        F.col("o_custkey").alias("patient_num"),
        F.col("o_orderdate").alias("start_date"),
        F.expr(AGE_SQL).alias("patient_age"),
        F.when(F.col("o_orderpriority").isin(*MRI_PRIORITIES), F.lit("MRI"))
         .otherwise(F.lit("CLINIC")).alias("location_cd"))


def _concept_dimension(spark: SparkSession) -> DataFrame:
    rows = ([(c, "CDE", i + 1) for i, c in enumerate(CDE_CONCEPTS)]
            + [(c, "LOCAL", len(CDE_CONCEPTS) + i + 1) for i, c in enumerate(LOCAL_CONCEPTS)])
    return spark.createDataFrame(rows, "concept_cd string, sourcesystem_cd string, upload_id int")


def _observation_fact(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order-level facts from one pass over orders, plus one fact per lineitem."""
    k = F.col("o_orderkey")
    diag = None
    for status, text in DIAGNOSIS_BY_STATUS:
        cond = F.col("o_orderstatus") == status
        diag = F.when(cond, F.lit(text)) if diag is None else diag.when(cond, F.lit(text))
    null_dec = F.lit(None).cast(DEC)
    null_str = F.lit(None).cast("string")

    def fact(concept, valtype, tval, nval, keep):
        return F.struct(F.lit(concept).alias("concept_cd"), F.lit(valtype).alias("valtype_cd"),
                        tval.alias("tval_char"), nval.alias("nval_num"), keep.alias("keep"))

    numeric_text = F.lit("E")
    per_order = F.array(
        fact("DIAG_etiology_1", "T", diag, null_dec, F.lit(True)),
        fact("minimentalstate", "N", numeric_text, (k % 31).cast(DEC), k % 3 == 0),
        fact("montrealcognitiveassessment", "N", numeric_text, (k % 31).cast(DEC), k % 5 == 0),
        fact("totalprice", "N", numeric_text,
             F.when(k % 11 == 0, null_dec).otherwise(F.col("o_totalprice").cast(DEC)), F.lit(True)),
        fact("priority", "T", F.when(k % 7 == 0, null_str).otherwise(F.col("o_orderpriority")),
             null_dec, F.lit(True)),
    )
    order_facts = (orders.select(k.alias("encounter_num"), F.col("o_custkey").alias("patient_num"),
                                 F.col("o_orderdate").alias("start_date"),
                                 F.inline(per_order))
                   .filter(F.col("keep"))
                   .select("encounter_num", "patient_num", "concept_cd", "start_date",
                           F.lit(1).alias("instance_num"), "valtype_cd", "tval_char", "nval_num"))
    # The line's own key, so that a filter of encounters reaches the lines.
    line_facts = (lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
                  .select(F.col("l_orderkey").alias("encounter_num"),
                          F.col("o_custkey").alias("patient_num"),
                          F.lit("quantity").alias("concept_cd"),
                          F.col("o_orderdate").alias("start_date"),
                          F.col("l_linenumber").alias("instance_num"),
                          F.lit("N").alias("valtype_cd"), numeric_text.alias("tval_char"),
                          F.col("l_quantity").cast(DEC).alias("nval_num")))
    return (order_facts.unionByName(line_facts)
            .select("encounter_num", "patient_num", "concept_cd",
                    F.lit(HOSPITAL).alias("provider_id"), "start_date",
                    F.lit("@").alias("modifier_cd"), "instance_num", "valtype_cd",
                    "tval_char", "nval_num"))


_VIEWS: dict[tuple[int, str, str], tuple[SparkSession, Mart]] = {}


def clinical_mart(spark: SparkSession, sf_dir: str, name: str = "harmonized") -> Mart:
    """Star tables of the clinical view (FIXTURES.md §3), all lazy.

    The view definitions (plans only, no data) are built once per session and
    folder, like registering views; every use still reads the tables.
    """
    key = (id(spark), sf_dir.rstrip("/"), name)
    hit = _VIEWS.get(key)
    if hit is not None and hit[0] is spark:
        return hit[1]
    mart = _build_clinical_mart(spark, sf_dir, name)
    _VIEWS[key] = (spark, mart)
    return mart


def _build_clinical_mart(spark: SparkSession, sf_dir: str, name: str) -> Mart:
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return Mart(
        patient_mapping=_patient_mapping(customer),
        encounter_mapping=_encounter_mapping(orders, customer),
        patient_dimension=_patient_dimension(customer),
        visit_dimension=_visit_dimension(orders),
        concept_dimension=_concept_dimension(spark),
        observation_fact=_observation_fact(orders, lineitem),
        name=name,
    )


#: Measure concepts of the wide mart, as many as a brain atlas has and some more.
WIDE_MEASURES = 140


def wide_mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The clinical mart and, per line item, a fact of one of ``WIDE_MEASURES``
    measure concepts (``vol_<number>``, by part)."""
    mart = clinical_mart(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    measures = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("encounter_num"), F.col("o_custkey").alias("patient_num"),
        F.concat(F.lit("vol_"), (F.col("l_partkey") % WIDE_MEASURES).cast("string")).alias("concept_cd"),
        F.lit(HOSPITAL).alias("provider_id"), F.col("o_orderdate").alias("start_date"), F.lit("@").alias("modifier_cd"),
        F.col("l_linenumber").alias("instance_num"), F.lit("N").alias("valtype_cd"), F.lit("E").alias("tval_char"),
        F.col("l_extendedprice").cast(DEC).alias("nval_num"))
    return mart.with_tables(observation_fact=mart.observation_fact.unionByName(measures))


def lineitem_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table: ids plus the four double measures of lineitem."""
    return read_table(spark, sf_dir, "lineitem").select(*LINEITEM_IDS, *LINEITEM_MEASURES)


def imaging_batch(spark: SparkSession, sf_dir: str, since: str | None = None, before: str | None = None) -> dict[str, DataFrame]:
    """A wide imaging batch derived from orders and lineitem, or of the orders
    of a time span (``since`` its first day, ``before`` the day behind its last).

    * ``mri_visits`` — one row per order: PATIENT_ID ``P<custkey>``, VISIT_ID
      ``V<orderkey>``, VISIT_DATE as ``dd/MM/yyyy`` text, PATIENT_AGE decimal.
    * ``volumes`` — one row per lineitem ("scan"): first column is the subject
      code ``P<custkey>_V<orderkey>``, then the four measures as decimal(18,5).
    """
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if since:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    if before:
        orders = orders.filter(F.col("o_orderdate") < F.lit(before).cast("timestamp_ntz"))
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", *LINEITEM_MEASURES)
    mri_visits = orders.select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("PATIENT_ID"),
        F.concat(F.lit("V"), F.col("o_orderkey").cast("string")).alias("VISIT_ID"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("VISIT_DATE"),
        F.expr(AGE_SQL).alias("PATIENT_AGE"))
    volumes = _volumes(lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey))
    return {"mri_visits": mri_visits, "volumes": volumes}


def imaging_batches(spark: SparkSession, sf_dir: str, bounds: Sequence[str]) -> list[dict[str, DataFrame]]:
    """:func:`imaging_batch` of the time spans that ``bounds`` (their first days)
    cut the orders into.  Scans are matched with their orders once for all
    batches and lie in a scratch folder, by batch, as deliveries do."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    span = F.lit(0)
    for day in bounds:
        span = span + (F.col("o_orderdate") >= F.lit(day).cast("timestamp_ntz")).cast("int")
    dated = orders.select("o_orderkey", "o_custkey", span.alias("span"))
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", *LINEITEM_MEASURES)
    joined = lineitem.join(dated, lineitem.l_orderkey == dated.o_orderkey).select("o_custkey", "o_orderkey", "span", *LINEITEM_MEASURES)
    path = scratch_path(spark, "batches")
    joined.write.partitionBy("span").option("compression", "zstd").parquet(path)
    scans = spark.read.schema(joined.schema).parquet(path)
    edges = [None, *bounds, None]
    return [{"mri_visits": imaging_batch(spark, sf_dir, a, b)["mri_visits"], "volumes": _volumes(scans.filter(F.col("span") == k))}
            for k, (a, b) in enumerate(zip(edges, edges[1:]))]


def _volumes(scans: DataFrame) -> DataFrame:
    return scans.select(F.concat(F.lit("P"), F.col("o_custkey").cast("string"), F.lit("_V"),
                                 F.col("o_orderkey").cast("string")).alias("subjectcode"),
                        *[F.col(c).cast(DEC).alias(c) for c in LINEITEM_MEASURES])


def imaging_patients(spark: SparkSession, sf_dir: str, patient_mapping: DataFrame) -> DataFrame:
    """patient_dimension of the imaging patients: the clinical view's sex rule
    through their new numbers."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey")
    return (patient_mapping.join(customer, F.col("patient_ide") == F.concat(F.lit("P"), customer.c_custkey.cast("string")))
            .select("patient_num", F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("sex_cd")))


#: Clinical concepts that the 6-months selection reads.
SELECTION_CONCEPTS = ("DIAG_etiology_1", "minimentalstate", "montrealcognitiveassessment")


def capture_mart(spark: SparkSession, sf_dir: str, load_time=None, clinical: bool = False) -> Mart:
    """Capture mart filled by the imaging ingest of :func:`imaging_batch`;
    ``clinical`` adds the diagnosis and cognitive test facts of the same visits
    (the clinical view's, under the capture mart's numbers).

    The imaging mapping does not fill patient_dimension; here it is derived
    from customer (sex rule of the clinical view) through the new patient
    numbers.  The capture concept dictionary has no CDE entries, so exports
    over it carry the demographic columns and the measure concepts.
    """
    from cohortmart.plans.ingest import ingest_imaging
    b = imaging_batch(spark, sf_dir)
    res = ingest_imaging(b["volumes"], b["mri_visits"], measures=LINEITEM_MEASURES,
                         hospital=HOSPITAL, load_time=load_time)
    t = res.targets
    pd = imaging_patients(spark, sf_dir, t["patient_mapping"])
    cd = spark.createDataFrame([], "concept_cd string, sourcesystem_cd string, upload_id int")
    facts = t["observation_fact"]
    if clinical:
        codes = (t["encounter_mapping"].select("encounter_ide", "patient_ide", F.col("encounter_num").alias("capture_num"))
                 .join(t["patient_mapping"].select("patient_ide", F.col("patient_num").alias("capture_patient")), "patient_ide"))
        tests = (clinical_mart(spark, sf_dir).observation_fact.filter(F.col("concept_cd").isin(*SELECTION_CONCEPTS))
                 .withColumn("encounter_ide", F.concat(F.lit("V"), F.col("encounter_num").cast("string"))).join(codes, "encounter_ide")
                 .withColumn("encounter_num", F.col("capture_num")).withColumn("patient_num", F.col("capture_patient"))
                 .drop("encounter_ide", "patient_ide", "capture_num", "capture_patient"))
        facts = facts.unionByName(tests, allowMissingColumns=True)
    return Mart(patient_mapping=t["patient_mapping"], encounter_mapping=t["encounter_mapping"],
                patient_dimension=pd, visit_dimension=t["visit_dimension"], concept_dimension=cd,
                observation_fact=facts, name="capture")
