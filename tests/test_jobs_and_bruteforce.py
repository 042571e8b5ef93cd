"""Jobs (mapping where, harmonize, CSV export/anonymization) and a brute-force
check of the exports on a randomized mart with one hot patient."""

import hashlib
import os
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortmart.operators.reshape import Catalog
from cohortmart.plans import export as X
from cohortmart.plans.jobs import (anonymize_csv, case_sensitive, export_csv_with_counters, extract_to_csv,
                                   harmonize)
from cohortmart.plans.mapping import Const, Copy, Expr, Join, MappingSpec, Target, run_mapping
from cohortmart.session import local_path, scratch_path
from cohortmart.sources.files import read_csv, recover_folder, write_csv
from cohortmart.sources.storage import Files
from tests.helpers import day, make_mart


def test_mapping_where_alias_join_and_constants(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id long, code string")
    b = spark.createDataFrame([("x", 10), ("y", 20)], "code string, v int")
    spec = MappingSpec(
        sources={"a": "A", "b": "B", "a1": "A"},
        joins=(Join(("a", "code"), ("b", "code")),),
        where=lambda c: c("b", "v") > 10, where_aliases=("b",),
        targets=(Target("t", (("id", Copy("a", "id")), ("v2", Expr(("b",), lambda c: c("b", "v") * 2)),
                              ("k", Const("K")))),
                 Target("u", (("id", Copy("a1", "id")),), distinct=True)))
    out = run_mapping(spec, {"A": a, "B": b})
    assert [tuple(r) for r in out["t"].collect()] == [(2, 40, "K")]
    assert sorted(r.id for r in out["u"].collect()) == [1, 2, 3]


def test_mapping_refuses_cross_product(spark):
    a = spark.createDataFrame([(1,)], "id long")
    spec = MappingSpec(sources={"a": "A", "b": "A"}, targets=(
        Target("t", (("x", Copy("a", "id")), ("y", Copy("b", "id")))),))
    try:
        run_mapping(spec, {"A": a})["t"]      # targets are built on access
        raise AssertionError("expected refusal")
    except ValueError as e:
        assert "cross product" in str(e)


def _mart(spark):
    visits = [(10, 1, 0, 65.5, "MRI"), (11, 1, 3, 65.6, "CLINIC")]
    facts = [(10, "priority", "T", "hi", None, 1), (11, "DIAG_etiology_1", "T", "AD", None, 1)]
    return make_mart(spark, [(1, "F")], visits, facts)


def test_harmonize_renames_concepts(spark):
    cap = _mart(spark)
    spec = MappingSpec(sources={"f": "observation_fact"}, targets=(Target("observation_fact", tuple(
        [(c, Copy("f", c)) for c in cap.observation_fact.columns if c != "concept_cd"]
        + [("concept_cd", Expr(("f",), lambda c: F.upper(c("f", "concept_cd"))))])),))
    h = harmonize(cap, spec)
    assert sorted(r.concept_cd for r in h.observation_fact.collect()) == ["DIAG_ETIOLOGY_1", "PRIORITY"]
    assert h.visit_dimension is cap.visit_dimension


def test_extract_to_csv_appends_dataset_column(spark):
    m = _mart(spark)
    out = scratch_path(spark, "exp")
    path = extract_to_csv({"harmonized": m, "capture": m}, "mindate", out, dataset="DS1")
    assert path.endswith("harmonized_clinical_data_min.csv")
    files = [f for f in os.listdir(local_path(path)) if f.endswith(".csv")]
    text = "".join(open(os.path.join(local_path(path), f)).read() for f in files)
    header = text.splitlines()[0].split(",")
    assert header[0] == "subjectcode" and header[-1] == "Dataset" and "dataset" in header
    assert "DS1" in text and spark.conf.get("spark.sql.caseSensitive") == "false"
    anon = extract_to_csv({"harmonized": m, "capture": m}, "6months", out, dataset="DS1",
                          anonymized=True, hash_method="md5")
    assert anon.endswith("harmonized_clinical_data_anon.csv")
    text = "".join(open(os.path.join(local_path(anon), f)).read()
                   for f in os.listdir(local_path(anon)) if f.endswith(".csv"))
    assert hashlib.md5(b"p1").hexdigest() in text and ",CLM," in text


def test_export_counters_observed_while_writing(spark):
    m = _mart(spark)
    _, counters = export_csv_with_counters({"harmonized": m, "capture": m}, "longitude",
                                           scratch_path(spark, "cnt"), dataset="DS")
    written = X.export(m, "longitude").cells.filter("w.v is not null").count()
    assert counters == {"cde_columns": 8, "inserts": 2, "updates": written} and written > 0
    assert {r.counter: r.value for r in X.export(m, "longitude").counters().collect()} == counters


def test_counters_scan_the_facts_once(spark):
    m, read = _mart(spark), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    n = m.observation_fact.count()
    facts = m.observation_fact.mapInArrow(counted, m.observation_fact.schema)
    catalog = Catalog.collect(m.observation_fact)
    export_csv_with_counters({"harmonized": m.with_tables(observation_fact=facts)}, "longitude", scratch_path(spark, "cnt"),
                             dataset="DS", catalog=catalog)
    assert read.value == n


def test_job_appends_all_or_nothing_and_survives_a_crash(spark):
    marts, out = {"harmonized": _mart(spark)}, scratch_path(spark, "job")
    columns = "subjectcode string, `Dataset` string"

    def codes(path):
        with case_sensitive(spark):
            return sorted(map(tuple, read_csv(spark, path, columns).collect()))

    def run(**kw):
        return export_csv_with_counters(marts, "mindate", out, csv_name="x.csv", **{"dataset": "DS", **kw})

    path, _ = run(anonymized=True, hash_method="md5", dataset="OLD")
    old = codes(path)
    files = Files(spark)
    files.rename(path, f"{path}._old")  # died between the two renames, the new folder incomplete
    files.write(f"{path}._new/part-0.csv", "half")
    path, counters = run(append=True)
    both = codes(path)
    assert set(old) < set(both) and len(both) == 2 * len(old) and "not_appended" not in counters
    _, counters = run(append=True, dataset="NEW")  # its own codes are there already
    assert counters["not_appended"] == "key already present" and {d for _, d in codes(path)} == {"NEW"}
    assert not [n for n in files.names(out) if n != "x.csv"]
    # A complete new folder that has not taken its name yet does so.
    files.rename(path, f"{path}._old")
    files.write(f"{path}._new/part-0.csv", "subjectcode,Dataset\nz,Z\n")
    files.write(f"{path}._new/_complete", "")
    assert recover_folder(spark, path) == "finished" and codes(path) == [("z", "Z")] and files.names(out) == ["x.csv"]
    # A file that cannot be read is left out as a whole.
    files.write(f"{path}/part-0.csv", "subjectcode\nz\n")
    _, counters = run(append=True)
    assert "not in the header" in counters["not_appended"] and len(codes(path)) == len(old)


def test_single_file_has_one_header_and_no_single_task(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "concat('a \"q\" ', id, '\n') AS `odd, name`")
    path = write_csv(df, scratch_path(spark, "one"), single_file=True)
    assert Files(spark).names(path) == [".part-00000.csv.crc", "part-00000.csv"] or Files(spark).names(path) == ["part-00000.csv"]
    assert Files(spark).read(f"{path}/part-00000.csv").startswith('id,"odd, name"\n')
    got = read_csv(spark, path, "id long, `odd, name` string")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    write_csv(df.limit(0), path, single_file=True)
    assert Files(spark).read(f"{path}/part-00000.csv") == 'id,"odd, name"\n'
    write_csv(read_csv(spark, write_csv(df, path), df.schema).filter("id < 10"), path)  # over what it reads
    assert read_csv(spark, path, df.schema).count() == 10


def test_anonymize_csv_uses_sha3_for_sha224(spark):
    src = scratch_path(spark, "flat")
    spark.createDataFrame([("p1", "a")], "subjectcode string, x string").write.option(
        "header", "true").csv(src)
    out = anonymize_csv(spark, src, scratch_path(spark, "anon"), "subjectcode string, x string")
    row = read_csv(spark, out, "subjectcode string, x string").first()
    assert row.subjectcode == hashlib.sha3_224(b"p1").hexdigest() and row.x == "a"


# ------------------------------------------------------------ brute force --

def _random_mart(spark, seed=7):
    rnd = random.Random(seed)
    patients = [(p, rnd.choice(["F", "M"])) for p in range(1, 13)]
    visits, facts, enc = [], [], 100
    for p, _ in patients:
        n = 30 if p == 1 else rnd.randint(1, 4)            # patient 1 is hot
        for _ in range(n):
            enc += 1
            visits.append((enc, p, rnd.randint(0, 40), round(rnd.uniform(45, 95), 2),
                           rnd.choice(["MRI", "CLINIC"])))
            for _ in range(rnd.randint(1, 6) if p != 1 else 12):
                concept = rnd.choice(["c1", "c2", "c3", "gender"])
                if rnd.random() < 0.5:
                    facts.append((enc, concept, "T", rnd.choice([None, "", "a", "b"]), None,
                                  rnd.randint(1, 2)))
                else:
                    facts.append((enc, concept if concept != "gender" else "c4", "N", "E",
                                  rnd.choice([None, 1, 2.5, 7]), rnd.randint(1, 2)))
    cdes = ("subjectageyears", "subjectage", "gender", "dataset", "agegroup", "c1")
    return make_mart(spark, patients, visits, facts, cdes=cdes), patients, visits, facts


def _render(vt, tval, nval):
    if vt == "T":
        return "" if tval is None else tval
    return None if nval is None else f"{Decimal(str(nval)):.5f}"


def _brute_extreme(patients, visits, facts, which):
    sex = dict(patients)
    by_p = defaultdict(list)
    for v in visits:
        by_p[v[1]].append(v)
    expected = {}
    for p, vs in by_p.items():
        edge = (min if which == "min" else max)(v[2] for v in vs)
        sel = [v for v in vs if v[2] == edge]
        encs = {v[0] for v in sel}
        cells = {}
        for e, c, vt, tval, nval, inst in facts:
            if e not in encs or (vt == "N" and nval is None):
                continue
            num = Decimal(str(nval)) if vt == "N" else None
            key = (e, inst, num if num is not None else Decimal("-1e30"), _render(vt, tval, nval))
            if c not in cells or key > cells[c][0]:
                cells[c] = (key, _render(vt, tval, nval))
        demo = max(sel, key=lambda v: v[0])
        row = {k: v[1] for k, v in cells.items()}
        row.setdefault("gender", sex[p])
        row["__years"] = str(int(Decimal(str(demo[3])) // 1))
        expected[f"p{p}"] = row
    return expected


@pytest.mark.parametrize("written_once", [True, False])
def test_extreme_exports_match_brute_force_with_hot_patient(spark, written_once):
    m, patients, visits, facts = _random_mart(spark)
    opts = X.with_options(X.DEFAULT, checkpoint_selection=written_once)
    for which, strategy in (("min", "mindate"), ("max", "maxdate")):
        got = {r.subjectcode: r.asDict() for r in X.export_frame(m, strategy, opts).collect()}
        exp = _brute_extreme(patients, visits, facts, which)
        assert set(got) == set(exp)
        for k, row in exp.items():
            g = got[k]
            assert g["subjectageyears"] == row["__years"], (k, which)
            assert g["gender"] == row["gender"], (k, which)
            for c in ("c1", "c2", "c3"):
                assert g.get(c) == row.get(c), (k, c, which)
            want = row.get("c4")
            assert (None if g.get("c4") is None else f"{g['c4']:.5f}") == want, (k, which)


@pytest.mark.parametrize("written_once", [True, False])
def test_longitude_matches_brute_force(spark, written_once):
    m, patients, visits, facts = _random_mart(spark, seed=11)
    opts = X.with_options(X.DEFAULT, checkpoint_selection=written_once)
    got = {(r.subjectcode, r.subjectvisitid): r.asDict()
           for r in X.export_frame(m, "longitude", opts).collect()}
    assert len(got) == len(visits)
    for e, p, d, age, _ in visits:
        cells = {}
        for fe, c, vt, tval, nval, inst in facts:
            if fe != e or (vt == "N" and nval is None):
                continue
            num = Decimal(str(nval)) if vt == "N" else Decimal("-1e30")
            key = (inst, num, _render(vt, tval, nval))
            if c not in cells or key > cells[c][0]:
                cells[c] = (key, _render(vt, tval, nval))
        g = got[(f"p{p}", f"v{e}")]
        assert g["subjectvisitdate"] == day(d)
        for c in ("c1", "c2", "c3"):
            assert g.get(c) == (cells[c][1] if c in cells else None), (e, c)
