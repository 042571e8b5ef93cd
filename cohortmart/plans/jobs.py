"""End-to-end jobs: strategy registry, flat CSV export, anonymized export, harmonize.

These are thin compositions of the lazy operators; each job ends in one
distributed write.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from cohortmart.functions.columns import qcol
from cohortmart.operators.anonymize import anonymize_flat
from cohortmart.functions.hashing import flat_csv_method
from cohortmart.operators.reshape import Catalog
from cohortmart.plans.export import AS_CODED, DEFAULT, OUTCOME, ExportOptions, ExportResult, export
from cohortmart.plans.mapping import MappingSpec, run_mapping
from cohortmart.schema import STAR_SCHEMAS, Mart
from cohortmart.sources.files import append_problem, read_csv, recover_folder, replace_folder, unreadable, write_csv
from cohortmart.sources.storage import Files


@dataclass(frozen=True)
class CsvStrategy:
    strategy: str
    csv_name: str
    options: ExportOptions = DEFAULT


# --- fixed values: output file names per strategy (plain / anonymized) ----
FLATTENING = {
    "mindate": CsvStrategy("mindate", "harmonized_clinical_data_min.csv"),
    "maxdate": CsvStrategy("maxdate", "harmonized_clinical_data_max.csv"),
    "6months": CsvStrategy("6months", "harmonized_clinical_data.csv"),
    "longitude": CsvStrategy("longitude", "harmonized_clinical_data_long.csv"),
}
ANONYMIZATION = {
    "mindate": CsvStrategy("mindate", "harmonized_clinical_data_min_anon.csv"),
    "maxdate": CsvStrategy("maxdate", "harmonized_clinical_data_max_anon.csv"),
    "6months": CsvStrategy("6months", "harmonized_clinical_data_anon.csv",
                           replace(DEFAULT, dataset_const="CLM")),
    "longitude": CsvStrategy("longitude", "harmonized_clinical_data_long_anon.csv"),
}
DEFAULT_HASH = "sha224"
# --------------------------------------------------------------------------


@contextmanager
def case_sensitive(spark: SparkSession):
    """Exports carry both ``dataset`` and ``Dataset``; resolve names exactly."""
    old = spark.conf.get("spark.sql.caseSensitive", "false")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", old)


def strategy_for(strategy: str, anonymized: bool = False, as_coded: bool = False) -> CsvStrategy:
    table = ANONYMIZATION if anonymized else FLATTENING
    if strategy not in table:
        raise ValueError(f"unknown strategy {strategy!r}; expected one of {sorted(table)}")
    s = table[strategy]
    if as_coded:
        s = replace(s, options=replace(AS_CODED, dataset_const=s.options.dataset_const))
    return s


def extract_to_csv(marts: Mapping[str, Mart], strategy: str, output_folder: str, *,
                   dataset: str, anonymized: bool = False, local: bool = False,
                   csv_name: str | None = None, hash_method: str = DEFAULT_HASH,
                   as_coded: bool = False, single_file: bool = False,
                   catalog: Catalog | None = None, append: bool = False) -> str:
    """Flat export of one strategy to ``<output_folder>/<csv name>``.

    ``local`` reads the capture mart instead of the harmonized one;
    ``anonymized`` hashes the ids of the result (the hash of an id is the same
    in every table and export of the method).
    A ``Dataset`` column with ``dataset`` is set or appended.  ``catalog``
    (``Catalog.collect`` of the same mart's facts) can be shared by several
    exports of one mart so its fact scan runs once.  ``append``: the rows of the
    export that is there stay too, all or none of them.
    """
    return export_csv_with_counters(marts, strategy, output_folder, dataset=dataset,
                                    anonymized=anonymized, local=local, csv_name=csv_name,
                                    hash_method=hash_method, as_coded=as_coded,
                                    single_file=single_file, catalog=catalog, append=append)[0]


def export_csv_with_counters(marts: Mapping[str, Mart], strategy: str, output_folder: str, *,
                             dataset: str, anonymized: bool = False, local: bool = False,
                             csv_name: str | None = None, hash_method: str = DEFAULT_HASH,
                             as_coded: bool = False, single_file: bool = False,
                             catalog: Catalog | None = None, append: bool = False) -> tuple[str, dict[str, int | str]]:
    """:func:`extract_to_csv` that also returns run counters: CDE columns,
    inserted rows and written facts, counted while the file is written; with
    ``append`` also why the previous export was left out, if it was
    (``not_appended``)."""
    mart = marts["capture" if local else "harmonized"]
    s = strategy_for(strategy, anonymized, as_coded)
    spark = mart.observation_fact.sparkSession
    path = f"{output_folder.rstrip('/')}/{csv_name or s.csv_name}"
    recover_folder(spark, path)
    with case_sensitive(spark):
        res = export(mart, s.strategy, replace(s.options, dataset=dataset, hash_ids=hash_method if anonymized else None),
                     catalog=catalog)
        out, counters = res.observed()
        problem: str | None = None
        if append and Files(spark).exists(path):
            previous, problem = _previous(spark, path, res)
            out = out if previous is None else out.unionByName(previous)
        write_csv(out, path, single_file=single_file)
        found: dict[str, int | str] = dict(counters())
    if problem:
        found["not_appended"] = problem
    return path, found


def _previous(spark: SparkSession, path: str, res: ExportResult) -> tuple[DataFrame | None, str | None]:
    """The export that is at ``path``, or why its rows cannot stay."""
    try:
        previous = read_csv(spark, path, res.frame.schema)
    except ValueError as e:  # a column is missing
        return None, str(e)
    # The codes of the new rows are needed for the check alone: from the selection, without the facts.
    keys = list(res.key_cols)
    problem = unreadable(previous) or append_problem(res.keys, previous.select(*[qcol(k) for k in keys]), keys)
    return (None, problem) if problem else (previous, None)


def export_outcomes(mart: Mart, strategy: str, path: str, options: ExportOptions = DEFAULT,
                    catalog: Catalog | None = None) -> dict[str, int]:
    """Accepted and rejected subjects and the counters from one run.

    The rows go to ``<path>/outcome=<accepted or why not>`` (parquet) in one
    write; facts of a bad value type are skipped.  The counters, rejected
    subjects and skipped facts among them, are observed on the way."""
    res = export(mart, strategy, replace(options, null_policy="tag", valtype_policy="lenient"), catalog=catalog)
    frame, counters = res.observed()
    replace_folder(mart.observation_fact.sparkSession, path, lambda folder: frame.write.partitionBy(OUTCOME).parquet(folder))
    return counters()


def anonymize_csv(spark: SparkSession, input_csv: str, output_csv: str, schema,
                  hash_df: str = DEFAULT_HASH, dataset: str | None = None) -> str:
    """Hash the first column of a flat CSV; the ``sha224`` choice means SHA3-224."""
    df = read_csv(spark, input_csv, schema)
    with case_sensitive(spark):
        write_csv(anonymize_flat(df, (0,), flat_csv_method(hash_df), dataset=dataset), output_csv)
    return output_csv


def harmonize(capture: Mart, spec: MappingSpec, name: str = "harmonized",
              keep_unmapped: bool = True) -> Mart:
    """Mart → mart mapping: the capture tables are the sources (by table name),
    each target of ``spec`` replaces the table of the same name; tables the
    spec does not produce are carried over when ``keep_unmapped``."""
    targets = run_mapping(spec, capture.tables())
    tables: dict[str, DataFrame] = {}
    for t in STAR_SCHEMAS:
        if t in targets:
            tables[t] = targets[t]
        elif keep_unmapped:
            tables[t] = capture.tables()[t]
        else:
            raise ValueError(f"mapping does not produce {t}")
    return Mart(**tables, name=name)
