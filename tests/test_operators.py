"""Operators outside the exports: split, unpivot, ids, mapping, hashing, sinks, plans."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from cohortmart.fixtures import clinical_mart
from cohortmart.functions import columns as C
from cohortmart.functions.hashing import hash_column
from cohortmart.operators import anonymize as A
from cohortmart.operators import identity as I
from cohortmart.operators import reshape as R
from cohortmart.operators.quality import bad_valtype
from cohortmart.plans import export as X
from cohortmart.plans.ingest import parse_visit_date
from cohortmart.session import local_path, scratch_path
from cohortmart.sources import files as FS
from cohortmart.sources.storage import Files

SF = "/root/testdata/sf0.001"


def test_split_subjectcode_strict_and_lenient(spark):
    df = spark.createDataFrame([("p1_v1", 1.0), ("p_1_2", 2.0), ("p", 3.0)], "code string, x double")
    lenient = C.split_subjectcode(df, mode="lenient").collect()
    assert [(r.PATIENT_ID, r.VISIT_ID, r.code) for r in lenient] == [("p1", "v1", "p1_v1")]
    assert sorted(r.code for r in C.split_rejects(df).collect()) == ["p", "p_1_2"]
    with pytest.raises(Exception, match="exactly one"):
        C.split_subjectcode(df).collect()


def test_unpivot_then_pivot_is_identity_on_non_null_cells(spark):
    wide = spark.createDataFrame([(1, 1.5, None), (2, 2.0, 3.0)], "id long, a double, b double")
    long = R.unpivot(R.UnpivotSpec(wide, ids=["id"], values=["a", "b"], drop_nulls=True))
    cells = long.select("id", F.col("Attribute").alias("concept_cd"),
                        R.winner_struct(F.lit(0), value=F.col("Value")).alias("w"))
    back = R.pivot_cells(R.winning_cells(cells, ["id"]), ["id"], ["a", "b"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_unpivot_keeps_nulls_by_default(spark):
    wide = spark.createDataFrame([(1, None)], "id long, a double")
    assert R.unpivot(R.UnpivotSpec(wide, ids=["id"], values=["a"])).count() == 1


def test_sequence_ids_dense_ordered_and_spread(spark):
    df = spark.range(0, 1000).select((F.col("id") % 37).alias("k"))  # many exact copies
    out = I.sequence_ids(df, ["k"], "sid", start=10, num_partitions=5).collect()
    ids = sorted(r.sid for r in out)
    assert ids == list(range(11, 1011))
    by_id = sorted(out, key=lambda r: r.sid)
    assert [r.k for r in by_id] == sorted(r.k for r in out)


def test_assign_ids_rerun_adds_nothing(spark):
    visits = spark.createDataFrame([("P1",), ("P2",), ("P1",)], "PATIENT_ID string")
    new1, full1 = I.assign_patient_num(visits, None, "H", "H")
    assert sorted((r.patient_ide, r.patient_num) for r in full1.collect()) == [("P1", 1), ("P2", 2)]
    new2, full2 = I.assign_patient_num(visits, full1, "H", "H")
    assert new2.count() == 0 and full2.count() == 2
    more = spark.createDataFrame([("P0",), ("P3",)], "PATIENT_ID string")
    new3, _ = I.assign_patient_num(more, full1, "H", "H")
    assert sorted((r.patient_ide, r.patient_num) for r in new3.collect()) == [("P0", 3), ("P3", 4)]


def test_parse_visit_date_strict_and_lenient(spark):
    df = spark.createDataFrame([("05/11/2019",), ("2019-11-05",)], "d string")
    got = df.select(parse_visit_date(F.col("d"), "lenient").alias("t")).collect()
    assert got[0].t.year == 2019 and got[0].t.month == 11 and got[1].t is None
    with pytest.raises(Exception):
        df.select(parse_visit_date(F.col("d"), "strict")).collect()


def test_hashes_match_hashlib(spark):
    df = spark.createDataFrame([("abc",), (None,)], "s string")
    r = df.select(hash_column(F.col("s"), "md5").alias("a"), hash_column(F.col("s"), "sha224").alias("b"),
                  hash_column(F.col("s"), "sha3_224").alias("c")).collect()
    assert r[0].a == hashlib.md5(b"abc").hexdigest()
    assert r[0].b == hashlib.sha224(b"abc").hexdigest()
    assert r[0].c == hashlib.sha3_224(b"abc").hexdigest()
    assert r[1].a is None and r[1].c is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_md5_mart_keeps_counts_and_join_cardinality(spark):
    m = clinical_mart(spark, SF)
    a = A.anonymize_mart(m, "md5")
    assert a.observation_fact.count() == m.observation_fact.count()
    j1 = m.observation_fact.join(m.visit_dimension, ["encounter_num", "patient_num"]).count()
    j2 = a.observation_fact.join(a.visit_dimension, ["encounter_num", "patient_num"]).count()
    assert j1 == j2
    assert X.export_frame(a, "mindate").count() == X.export_frame(m, "mindate").count()


def test_csv_roundtrip_awkward_text(spark):
    df = spark.createDataFrame([("d'Alzheimer", "50%"), ('a,"b"', ""), (None, "x")], "a string, b string")
    path = FS.write_csv(df, scratch_path(spark, "t"))
    back = FS.read_csv(spark, path, df.schema).collect()
    assert sorted(map(tuple, back), key=str) == sorted(
        [("d'Alzheimer", "50%"), ('a,"b"', None), (None, "x")], key=str)
    text = "".join(open(os.path.join(local_path(path), f)).read()
                   for f in os.listdir(local_path(path)) if f.endswith(".csv"))
    assert '"a,""b"""' in text


def test_append_export_all_or_nothing(spark):
    new = spark.createDataFrame([("a", "1")], "subjectcode string, v string")
    clash = spark.createDataFrame([("a", "2"), ("b", "3")], "subjectcode string, v string")
    fresh = spark.createDataFrame([("b", "3")], "subjectcode string, v string")
    other = spark.createDataFrame([("b", "3", "x")], "subjectcode string, v string, w string")
    assert FS.append_export(new, clash, ["subjectcode"]).count() == 1
    assert FS.append_export(new, fresh, ["subjectcode"]).count() == 2
    assert FS.append_export(new, other, ["subjectcode"]).count() == 1


def test_batch_scan_requires_files(spark, tmp_path):
    os.mkdir(tmp_path / "empty")
    with pytest.raises(FileNotFoundError, match="holds no files"):
        FS.read_batch(spark, str(tmp_path), "empty", "a string")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        FS.read_batch(spark, str(tmp_path), "missing", "a string")


def test_bad_valtype_reject_table(spark):
    f = spark.createDataFrame([("N",), ("T",), ("D",), (None,)], "valtype_cd string")
    assert sorted(str(r.valtype_cd) for r in bad_valtype(f).collect()) == ["D", "None"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_six_months_plan_has_no_nested_loop_or_cartesian(spark):
    df = X.export_frame(clinical_mart(spark, SF), "6months")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_export_reads_only_needed_fact_columns(spark):
    from cohortmart.schema import Mart
    root = scratch_path(spark, "mart")
    clinical_mart(spark, SF).write_parquet(root)
    plan = X.export_frame(Mart.from_parquet(spark, root), "mindate")._jdf.queryExecution().executedPlan().toString()
    reads = [line for line in plan.split("\n") if "ReadSchema" in line and "nval_num" in line]
    assert len(reads) == 1 and "provider_id" not in reads[0] and "modifier_cd" not in reads[0]
    assert "PushedFilters" in reads[0]


def test_csv_keeps_text_and_finds_columns_by_name(spark):
    rows = [("  padded  ", 1), ("two\nlines, \"quoted\"", 2), ("plain", 3)]
    df = spark.createDataFrame(rows, "t string, n int")
    path = FS.write_csv(df, scratch_path(spark, "csv"), single_file=True)
    assert sorted(map(tuple, FS.read_csv(spark, path, "n int, t string").collect())) == sorted((n, t) for t, n in rows)
    with pytest.raises(ValueError, match="not in the header"):
        FS.read_csv(spark, path, "n int, other string")
    assert {r.other for r in FS.read_csv(spark, path, "n int, other string", missing="null").collect()} == {None}
    bad = FS.write_csv(spark.createDataFrame([("x",)], "n string"), scratch_path(spark, "csv"))
    with pytest.raises(Exception):
        FS.read_csv(spark, bad, "n int").collect()


def test_append_refuses_null_and_repeated_keys(spark):
    new = spark.createDataFrame([("a", "1")], "subjectcode string, v string")
    for rows, why in (([("b", "1"), ("b", "2")], "repeated key"), ([(None, "1")], "NULL key"), ([("a", "2")], "key already present"), ([("b", "2")], None)):
        prev = spark.createDataFrame(rows, new.schema)
        assert FS.append_problem(new, prev, ["subjectcode"]) == why
        assert FS.append_export(new, prev, ["subjectcode"]).count() == (1 if why else 1 + len(rows))


def test_read_batch_tags_batch_and_file(spark):
    root = scratch_path(spark, "batches")
    FS.write_csv(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), f"{root}/b7")
    rows = FS.read_batch(spark, root, "b7", "k string, v int").collect()
    assert sorted((r.k, r.v, r.batch) for r in rows) == [("a", 1, "b7"), ("b", 2, "b7")]
    assert all("/b7/" in r.source_file for r in rows)


def test_union_frames_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, "y")], "id long, b string")
    got = sorted(map(tuple, FS.union_frames([a, b]).collect()), key=lambda t: t[0])
    assert got == [(1, "x", None), (2, None, "y")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
def test_mart_parquet_roundtrip(spark):
    from cohortmart.schema import Mart
    m = clinical_mart(spark, SF)
    root = scratch_path(spark, "mart")
    m.write_parquet(root)
    back = Mart.from_parquet(spark, root)
    for t, df in m.tables().items():
        assert back.tables()[t].count() == df.count(), t
    assert m.catalog is None and {r.concept_cd for r in back.catalog.collect()} >= {"priority", "quantity"}
    assert back.with_tables(observation_fact=m.observation_fact).catalog is None
    a = sorted(map(tuple, X.export_frame(back, "maxdate").collect()))
    assert a == sorted(map(tuple, X.export_frame(m, "maxdate").collect()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")
@pytest.mark.parametrize("strategy", ["mindate", "maxdate", "6months", "longitude"])
def test_export_keys_are_unique(spark, strategy):
    from cohortmart.operators.quality import key_violations
    res = X.export(clinical_mart(spark, SF), strategy)
    assert res.frame.count() > 0
    assert key_violations(res.frame, res.key_cols).count() == 0


def test_sequence_ids_unordered_dense_unique(spark):
    df = spark.range(0, 777, numPartitions=5).select((F.col("id") % 3).alias("k"))
    out = I.sequence_ids(df, [], "sid", start=5).collect()
    assert sorted(r.sid for r in out) == list(range(6, 783))


def test_headers_are_read_from_the_first_bytes(spark):
    root = scratch_path(spark, "headers")
    files = Files(spark)
    files.write(f"{root}/a.csv", "﻿n,\"two\nlines\"\r\n" + "".join(f"{i},\"x\n{i}\"\r\n" for i in range(5000)))
    files.write(f"{root}/b.csv", "t\n" + "y\n" * 10)
    files.write(f"{root}/c.csv", "n,\"two\nlines\"\n")
    found = {tuple(h): [f.rsplit("/", 1)[-1] for f in fs] for h, fs in FS._files_by_header(spark, root)}
    assert found == {("n", "two\nlines"): ["a.csv", "c.csv"], ("t",): ["b.csv"]}


def test_large_quoted_file_is_read_by_several_tasks(spark, monkeypatch):
    import random
    r = random.Random(3)
    rows = [(i, r.choice(["plain", "two\nlines", 'q"uo\n"te,\n\nd', "\n" * 40 + "x", "", "a" * r.randint(0, 300)])) for i in range(3000)]
    root = scratch_path(spark, "big")
    FS.write_csv(spark.createDataFrame(rows, "i int, t string").coalesce(1), root)
    whole = sorted(map(tuple, FS.read_csv(spark, root, "t string, i int").collect()), key=str)
    assert len(whole) == 3000
    monkeypatch.setattr(FS, "SPLIT_BYTES", 1000)
    with FS.settings(spark, {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}):
        cut = FS.read_csv(spark, root, "t string, i int")
        assert sorted(map(tuple, cut.collect()), key=str) == whole
        parts = cut.select(F.spark_partition_id()).distinct().count()
        monkeypatch.setattr(FS, "MAX_BLOCKS", -1)
        assert sorted(map(tuple, FS.read_csv(spark, root, "t string, i int").collect()), key=str) == whole
    assert parts > 5
    bad = scratch_path(spark, "bad")
    Files(spark).write(f"{bad}/x.csv", "i,t\n" + "1,x\n" * 500 + "no number,y\n")
    with pytest.raises(Exception):
        FS.read_csv(spark, bad, "i int, t string").collect()


def test_header_of_a_large_file_is_read_by_no_task(spark, monkeypatch, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x y.csv").write_bytes('\ufeffid,"a ""q""\r\nb"\r\n'.encode() + b"1,2\r\n" * 5000)
    (tmp_path / "a" / "z.csv").write_text("id,v\n1,2\n")
    want = FS._files_by_header(spark, str(tmp_path / "a"))
    monkeypatch.setattr(FS, "SPLIT_BYTES", 1000)
    opened, reader = [], type(spark.read)
    text = reader.text
    monkeypatch.setattr(reader, "text", lambda self, paths, *a, **kw: opened.append(paths) or text(self, paths, *a, **kw))
    assert FS._files_by_header(spark, str(tmp_path / "a")) == want
    assert [h for h, _ in want] == [["id", 'a "q"\r\nb'], ["id", "v"]]
    assert len(opened) == 1 and [f.rsplit("/", 1)[-1] for f in opened[0]] == ["z.csv"]


def test_merge_reconciles_types_of_many_headers(spark):
    root, files = scratch_path(spark, "mixed"), Files(spark)
    files.write(f"{root}/a.csv", "id,v,d,t\n1,10,2020-01-31,1\n2,,2020-02-29,x\n")
    files.write(f"{root}/b.csv", "t,id,v,w\n7,3,1.50,2020-01-01\n")
    files.write(f"{root}/c.csv", "id,w,e\n4,5,\n")
    for k in range(40):
        files.write(f"{root}/more{k:02}.csv", f"id,only{k}\n{100 + k},{k}\n")
    schema = FS.reconciled_schema(spark, root)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert [kinds[c] for c in ("id", "v", "d", "t", "w", "e")] == ["bigint", "decimal(18,5)", "date", "string", "string", "string"]
    df = FS.merge_outputs(spark, root)
    assert len(df.columns) == 6 + 40 and df.count() == 4 + 40
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = {r.id: r for r in df.collect()}
    assert str(got[3].v) == "1.50000" and str(got[1].d) == "2020-01-31" and got[4].w == "5" and got[2].v is None and got[107].only7 == 7


def test_cells_are_gathered_before_they_are_spread_over_columns(spark):
    cells = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "b", "z")], "id long, concept_cd string, v string")
    wide = R.pivot_cells(cells, ["id"], ["a", "b"])
    assert sorted(map(tuple, wide.collect())) == [(1, "x", "y"), (2, None, "z")]
    plan = wide._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_COL" in plan


def test_columns_are_spread_last_without_an_expression_a_column_in_an_aggregate(spark):
    cells = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (1, None, "n"), (2, "b", "z"), (2, "a", None), (3, "other", "o")],
                                  "id long, concept_cd string, v string")
    names = ["b", "a", *[f"c{i}" for i in range(12)]]
    wide = R.pivot_cells(cells, ["id"], names)
    empty = (None,) * 12
    assert wide.columns == ["id", *names]
    assert sorted(map(tuple, wide.collect())) == [(1, "y", "x", *empty), (2, "z", None, *empty), (3, None, None, *empty)]
    # Rows that the wide ones are joined to: each keeps its place, and what is joined is narrow.
    rows = spark.createDataFrame([(2, "two"), (4, "four"), (2, "again")], "key long, name string")
    beside = R.pivot_cells(cells, ["id"], names, rows, F.col("key") == F.col("id"))
    assert sorted(tuple(r)[:5] for r in beside.drop("id").collect()) == [(2, "again", "z", None, None), (2, "two", "z", None, None), (4, "four", None, None, None)]
    for plan in (wide, beside):
        lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert not any("c11" in line for line in lines if "Project [" not in line)
        assert sum("AS c11#" in line for line in lines) == 1 and "AS c11#" in lines[0]


def test_bitmap_filter_reaches_the_scan_below_a_union_and_a_join(spark):
    from cohortmart.operators import identity as I
    lines = spark.range(100).selectExpr("id as line", "id % 7 as n")
    orders = spark.range(100).selectExpr("id as key")
    facts = lines.join(orders, F.col("line") == F.col("key")).select(F.col("line").alias("k"), "n").unionByName(
        spark.range(50).selectExpr("id as k", "id as n"))
    kept = I.in_bitmap(facts, spark.createDataFrame([(3,), (60,)], "k long"), ["k"], 1 << 20)
    assert sorted(r.k for r in kept.collect()) == [3, 3, 60]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("Join Inner") < plan.index("Join LeftSemi")


def test_an_append_is_decided_by_the_keys_alone(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "subjectcode string")
    new = keys.filter(F.when(F.col("subjectcode") > "", F.raise_error(F.lit("rows were computed"))).otherwise(F.lit(True)))
    clash, fresh = (spark.createDataFrame([(k,)], "subjectcode string") for k in "bc")
    assert "Union" not in FS.append_export(new, clash, ["subjectcode"], keys)._jdf.queryExecution().analyzed().toString()
    assert "Union" in FS.append_export(new, fresh, ["subjectcode"], keys)._jdf.queryExecution().analyzed().toString()
