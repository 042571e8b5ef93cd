"""Star-schema table types and the :class:`Mart` handle."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortmart.sources.storage import Files

DEC = T.DecimalType(18, 5)

PATIENT_MAPPING = T.StructType([
    T.StructField("patient_ide", T.StringType()),
    T.StructField("patient_ide_source", T.StringType()),
    T.StructField("project_id", T.StringType()),
    T.StructField("patient_num", T.LongType()),
    T.StructField("import_date", T.TimestampType()),
])

ENCOUNTER_MAPPING = T.StructType([
    T.StructField("encounter_ide", T.StringType()),
    T.StructField("encounter_ide_source", T.StringType()),
    T.StructField("project_id", T.StringType()),
    T.StructField("patient_ide", T.StringType()),
    T.StructField("patient_ide_source", T.StringType()),
    T.StructField("encounter_num", T.LongType()),
    T.StructField("import_date", T.TimestampType()),
])

PATIENT_DIMENSION = T.StructType([
    T.StructField("patient_num", T.LongType()),
    T.StructField("sex_cd", T.StringType()),
])

VISIT_DIMENSION = T.StructType([
    T.StructField("encounter_num", T.LongType()),
    T.StructField("patient_num", T.LongType()),
    T.StructField("start_date", T.TimestampNTZType()),
    T.StructField("patient_age", DEC),
    T.StructField("location_cd", T.StringType()),
    T.StructField("import_date", T.TimestampType()),
])

CONCEPT_DIMENSION = T.StructType([
    T.StructField("concept_cd", T.StringType()),
    T.StructField("sourcesystem_cd", T.StringType()),
    T.StructField("upload_id", T.IntegerType()),
])

OBSERVATION_FACT = T.StructType([
    T.StructField("encounter_num", T.LongType()),
    T.StructField("patient_num", T.LongType()),
    T.StructField("concept_cd", T.StringType()),
    T.StructField("provider_id", T.StringType()),
    T.StructField("start_date", T.TimestampNTZType()),
    T.StructField("modifier_cd", T.StringType()),
    T.StructField("instance_num", T.IntegerType()),
    T.StructField("valtype_cd", T.StringType()),
    T.StructField("tval_char", T.StringType()),
    T.StructField("nval_num", DEC),
    T.StructField("text_search_index", T.LongType()),
    T.StructField("location_cd", T.StringType()),
    T.StructField("import_date", T.TimestampType()),
])

STAR_SCHEMAS = {
    "patient_mapping": PATIENT_MAPPING,
    "encounter_mapping": ENCOUNTER_MAPPING,
    "patient_dimension": PATIENT_DIMENSION,
    "visit_dimension": VISIT_DIMENSION,
    "concept_dimension": CONCEPT_DIMENSION,
    "observation_fact": OBSERVATION_FACT,
}

# Folder of the stored concept catalog, beside the star tables: facts by concept,
# provider and value type, counted write by write and summed up when read.  The
# stamp beside it says which fact files it covers.
CATALOG = "concept_catalog"
CATALOG_STAMP = "_covers"
CATALOG_DELTA = T.StructType([
    T.StructField("concept_cd", T.StringType()),
    T.StructField("provider_id", T.StringType()),
    T.StructField("valtype_cd", T.StringType()),
    T.StructField("n", T.LongType()),
])

# Bucketing of the star tables: exports join facts to selected encounters on
# encounter_num and aggregate visits per patient, so facts and encounter maps
# are bucketed by encounter_num and patient-level tables by patient_num.
BUCKET_KEYS = {
    "patient_mapping": "patient_num",
    "encounter_mapping": "encounter_num",
    "patient_dimension": "patient_num",
    "visit_dimension": "patient_num",
    "observation_fact": "encounter_num",
}

# Identifier columns that carry a patient or encounter identity; these are the
# columns hashed by mart anonymization so that joins still line up.
ID_COLUMNS = ("patient_num", "encounter_num", "patient_ide", "encounter_ide")


@dataclass(frozen=True)
class Mart:
    """The star tables of one mart (capture, harmonized or anonymized).

    Each field is a lazy DataFrame; a mart built from parquet or catalog
    tables keeps scans lazy so Catalyst can prune columns and push filters
    into every job that reads it.
    """

    patient_mapping: DataFrame
    encounter_mapping: DataFrame
    patient_dimension: DataFrame
    visit_dimension: DataFrame
    concept_dimension: DataFrame
    observation_fact: DataFrame
    name: str = "harmonized"
    #: The stored concept catalog of the facts, where the mart has one.
    catalog: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {t: getattr(self, t) for t in STAR_SCHEMAS}

    def with_tables(self, **tables: DataFrame) -> "Mart":
        if "observation_fact" in tables:  # the catalog describes the old facts
            tables.setdefault("catalog", None)
        return replace(self, **tables)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, name: str = "harmonized", stale: str = "recount") -> "Mart":
        """Open ``<root>/<table>`` parquet folders lazily, with the stored concept
        catalog where it covers the facts that are there.  Where facts were
        added or taken away by another path, the catalog is left alone
        (``stale="recount"``: exports count the facts themselves) or refused
        (``stale="fail"``)."""
        root = root.rstrip("/")
        catalog = stored_catalog(spark, root)
        if catalog is None and stale == "fail":
            raise ValueError(f"the concept catalog of {root} does not cover its facts")
        if stale not in ("recount", "fail"):
            raise ValueError("stale must be 'recount' or 'fail'")
        return cls(**{t: spark.read.parquet(f"{root}/{t}") for t in STAR_SCHEMAS}, name=name, catalog=catalog)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, name: str | None = None, root: str | None = None) -> "Mart":
        """Open catalog tables ``<database>.<table>`` (bucketed tables keep their
        layout); ``root``: where their files and the concept catalog are."""
        return cls(**{t: spark.table(f"{database}.{t}") for t in STAR_SCHEMAS},
                   name=name or database, catalog=stored_catalog(spark, root.rstrip("/")) if root else None)

    def write_parquet(self, root: str, mode: str = "overwrite") -> None:
        """Write (or append) the star tables and the concept catalog of the facts,
        so that exports of the stored mart need no pass over them to learn their
        columns.  An append counts the facts that it adds, from the files that it
        wrote; all facts are counted only if the catalog did not cover those before."""
        from cohortmart.operators.reshape import concept_triples
        root, spark = root.rstrip("/"), self.observation_fact.sparkSession
        facts = f"{root}/observation_fact"
        covered = mode == "append" and stored_catalog(spark, root) is not None
        before = set(spark.read.parquet(facts).inputFiles()) if covered else set()
        for t, df in self.tables().items():
            df.write.mode(mode).parquet(f"{root}/{t}")
        now = spark.read.parquet(facts)
        if covered:
            added = [f for f in now.inputFiles() if f not in before]
            now = spark.read.schema(OBSERVATION_FACT).parquet(*added) if added else now.limit(0)
        concept_triples(now).write.mode("append" if covered else "overwrite").parquet(f"{root}/{CATALOG}")
        stamp_catalog(spark, root)

    def save_bucketed(self, database: str, root: str, buckets: int,
                      mode: str = "overwrite") -> "Mart":
        """Write the star tables as bucketed catalog tables stored under ``root``
        (shared storage) and return the mart reading them back.

        Joins and aggregations on the bucket key then find their input already
        hash-partitioned, so the large fact table is not shuffled by the export
        join on encounter_num; only the smaller side is shuffled to match.
        """
        spark = self.observation_fact.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} "
                  f"LOCATION '{root.rstrip('/')}/_{database}.db'")
        for t, df in self.tables().items():
            w = df.write.mode(mode).format("parquet").option("path", f"{root.rstrip('/')}/{t}")
            key = BUCKET_KEYS.get(t)
            if key is not None:
                w = w.bucketBy(buckets, key).sortBy(key)
            w.saveAsTable(f"{database}.{t}")
        from cohortmart.operators.reshape import concept_triples
        concept_triples(spark.table(f"{database}.observation_fact")).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{CATALOG}")
        stamp_catalog(spark, root)
        return Mart.from_catalog(spark, database, name=self.name, root=root)


def _covered(files: Files, root: str) -> str:
    n, length = files.size(f"{root}/observation_fact")
    return f"{n} files, {length} bytes"


def stamp_catalog(spark: SparkSession, root: str) -> None:
    """Note beside the stored catalog which fact files it covers."""
    files, root = Files(spark), root.rstrip("/")
    files.write(f"{root}/{CATALOG}/{CATALOG_STAMP}", _covered(files, root))


def stored_catalog(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored concept catalog; None if there is none, or if the facts are not
    those that it was counted from."""
    from cohortmart.operators.reshape import merged_catalog
    files, stamp = Files(spark), f"{root}/{CATALOG}/{CATALOG_STAMP}"
    if not files.exists(stamp) or not files.exists(f"{root}/observation_fact") or files.read(stamp) != _covered(files, root):
        return None
    return merged_catalog(spark.read.schema(CATALOG_DELTA).parquet(f"{root}/{CATALOG}"))
