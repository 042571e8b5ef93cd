"""Registered queries over marts that are stored and loaded batch by batch.

The batches are the orders of three time spans; each query loads them into a
store of its own under the shared scratch folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmart.fixtures import HOSPITAL, LINEITEM_MEASURES, clinical_mart, imaging_batch, imaging_batches, imaging_patients, read_table
from cohortmart.plans import export as X
from cohortmart.plans import ingest as G
from cohortmart.plans import loads as L
from cohortmart.queries import LOAD_TIME_SQL, register
from cohortmart.schema import DEC, Mart
from cohortmart.session import scratch_path
from cohortmart.sources.files import write_csv
from cohortmart.store import MartStore, Snapshot

#: First days of the second and third batch.
SPANS = ("1997-01-01", "1999-01-01")


class _Killed(RuntimeError):
    """Stands for a driver that dies between the rows and the commit."""


def _kill() -> None:
    raise _Killed


def _batches(spark: SparkSession, sf_dir: str) -> list[dict[str, DataFrame]]:
    return imaging_batches(spark, sf_dir, SPANS)


def _load(store: MartStore, name: str, batch: dict[str, DataFrame], **kw) -> Snapshot:
    return L.load_imaging(store, name, batch["volumes"], batch["mri_visits"], LINEITEM_MEASURES, HOSPITAL,
                          F.expr(LOAD_TIME_SQL), G.FACT_ORDER, **kw)


def _loaded(spark: SparkSession, sf_dir: str) -> MartStore:
    """Three loads; the second dies first, after its rows are written, and is
    started again."""
    store, batches = MartStore(spark, scratch_path(spark, "store"), buckets=8), _batches(spark, sf_dir)
    before = _load(store, "early", batches[0])
    try:
        _load(store, "middle", batches[1], before_commit=_kill)
    except _Killed:
        if store.snapshot() != before:
            raise RuntimeError("a load that died is visible") from None
    _load(store, "middle", batches[1])
    _load(store, "late", batches[2])
    return store


@register("loads_patients")
def loads_patients(spark, sf_dir):
    """The patient map after three loads, one of them started twice."""
    return _loaded(spark, sf_dir).read("patient_mapping").drop("bucket", "import_date")


@register("loads_visits")
def loads_visits(spark, sf_dir):
    """The visits after three loads, one of them started twice, with their codes."""
    store = _loaded(spark, sf_dir)
    codes = store.read("encounter_mapping").select("encounter_num", "encounter_ide")
    return store.read("visit_dimension").join(codes, "encounter_num").select(
        "encounter_num", "encounter_ide", "patient_num", "start_date", "patient_age", "location_cd")


@register("loads_facts")
def loads_facts(spark, sf_dir):
    """The facts after three loads, one of them started twice; their
    numbers go on from load to load."""
    return _loaded(spark, sf_dir).read("observation_fact").drop("bucket", "import_date")


@register("stored_first_visits")
def stored_first_visits(spark, sf_dir):
    """First visits from the state that three loads kept up to date."""
    store = _loaded(spark, sf_dir)
    return (L.stored_extreme_visits(store, "min").join(store.read("patient_mapping").select("patient_num", "patient_ide"), "patient_num")
            .join(store.read("encounter_mapping").select("encounter_num", "encounter_ide"), "encounter_num")
            .select("patient_ide", "encounter_ide", "start_date", "patient_age"))


@register("stored_last_visits")
def stored_last_visits(spark, sf_dir):
    """Last visits, loaded late batch first: earlier and later dates merge."""
    store, batches = MartStore(spark, scratch_path(spark, "store"), buckets=8), _batches(spark, sf_dir)
    for k in (2, 0, 1):
        _load(store, str(k), batches[k])
    return (L.stored_extreme_visits(store, "max").join(store.read("patient_mapping").select("patient_num", "patient_ide"), "patient_num")
            .join(store.read("encounter_mapping").select("encounter_num", "encounter_ide"), "encounter_num")
            .select("patient_ide", "encounter_ide", "start_date", "patient_age"))


def _refreshed(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    store, batches = MartStore(spark, scratch_path(spark, "store"), buckets=8), _batches(spark, sf_dir)
    dictionary = spark.createDataFrame([], "concept_cd string, sourcesystem_cd string, upload_id int")
    for k, batch in enumerate(batches):
        _load(store, str(k), batch)
        L.refresh_export(store, strategy, imaging_patients(spark, sf_dir, store.read("patient_mapping")), dictionary)
    return L.read_export(store, strategy)


@register("stored_export_mindate")
def stored_export_mindate(spark, sf_dir):
    """The stored mindate export, refreshed after each of three loads."""
    return _refreshed(spark, sf_dir, "mindate")


@register("stored_export_maxdate")
def stored_export_maxdate(spark, sf_dir):
    """The stored maxdate export; most rows change with every load."""
    return _refreshed(spark, sf_dir, "maxdate")


@register("ledger_offers")
def ledger_offers(spark, sf_dir):
    """O2: a batch folder of five files offered three times, the last time with
    one file changed: (offer, status, files, visits in the mart afterwards).  Only
    new files are loaded; a changed one is reported and left out."""
    root, store = scratch_path(spark, "offers"), MartStore(spark, scratch_path(spark, "store"), buckets=8)
    whole, out = imaging_batch(spark, sf_dir), []
    write_csv(whole["mri_visits"].withColumn("PATIENT_AGE", F.col("PATIENT_AGE").cast("string")).repartition(5), f"{root}/b1")
    schema = "PATIENT_ID string, VISIT_ID string, VISIT_DATE string, PATIENT_AGE decimal(18,5)"
    for k in (1, 2, 3):
        if k == 3:
            name = next(n for n in store.files.names(f"{root}/b1") if n.endswith(".csv"))
            text = store.files.read(f"{root}/b1/{name}")
            store.files.write(f"{root}/b1/{name}", text + "P0,V0,01/01/2000,50.00000\n")
        offer = L.offered_files(store, root, "b1")
        fresh = offer.paths("new")
        if fresh:
            from cohortmart.sources.files import read_csv
            L.load_imaging(store, "b1", whole["volumes"], read_csv(spark, fresh, schema), LINEITEM_MEASURES, HOSPITAL,
                           F.expr(LOAD_TIME_SQL), files=offer.entries("new"))
        visits = store.read("visit_dimension").agg(F.count(F.lit(1)).alias("n_visits"))
        out.append(offer.files.groupBy("status").agg(F.count(F.lit(1)).alias("n_files")).crossJoin(visits)  # one row
                   .select(F.lit(k).alias("offer"), "status", "n_files", "n_visits"))
    return reduce(DataFrame.unionByName, out)


@register("stale_catalog_mindate")
def stale_catalog_mindate(spark, sf_dir):
    """A stored mart to which another path appended facts of a new concept:
    the catalog does not cover them, so the export counts anew and has the column."""
    root, mart = scratch_path(spark, "mart"), clinical_mart(spark, sf_dir)
    mart.write_parquet(root)
    orders = read_table(spark, sf_dir, "orders")
    late = orders.select(F.col("o_orderkey").alias("encounter_num"), F.col("o_custkey").alias("patient_num"),
                         F.lit("latecomer").alias("concept_cd"), F.lit(HOSPITAL).alias("provider_id"),
                         F.col("o_orderdate").alias("start_date"), F.lit("@").alias("modifier_cd"), F.lit(1).alias("instance_num"),
                         F.lit("N").alias("valtype_cd"), F.lit("E").alias("tval_char"), (F.col("o_orderkey") % 97).cast(DEC).alias("nval_num"))
    late.write.mode("append").parquet(f"{root}/observation_fact")
    return X.export_frame(Mart.from_parquet(spark, root), "mindate")
