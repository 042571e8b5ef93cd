"""Hand-written golden cases for the export decisions (FIXTURES.md §2)."""

import pytest
from pyspark.sql import functions as F

from cohortmart.functions import columns as C
from cohortmart.plans import export as X
from tests.helpers import make_mart, rows_by


def test_age_parts_month_rounds_to_twelve(spark):
    df = spark.sql("SELECT cast(65.97 AS decimal(18,5)) AS a")
    r = df.select(C.age_years(F.col("a")).alias("y"), C.age_months(F.col("a")).alias("m")).first()
    assert (r.y, int(r.m)) == (65, 12)


def test_age_band_edges(spark):
    ages = [49.9, 50.0, 60.0, 70.0, 80.0, 89.9, 90.0, None]
    df = spark.createDataFrame([(a,) for a in ages], "a double")
    got = [r.g for r in df.select(C.age_group(C.age_years(F.col("a"))).alias("g")).collect()]
    assert got == ["-50y", "50-59y", "60-69y", "70-79y", "70-79y", "70-79y", "+80y", None]


def _basic(spark, facts, visits=None, patients=None, **kw):
    patients = patients or [(1, "F")]
    visits = visits or [(10, 1, 0, 65.5, "MRI"), (11, 1, 40, 66.0, "CLINIC")]
    return make_mart(spark, patients, visits, facts, **kw)


def test_typed_values_null_text_and_null_number(spark):
    m = _basic(spark, [(10, "priority", "T", None, None, 1), (10, "minimentalstate", "N", "E", None, 1),
                       (10, "totalprice", "N", "E", 12.5, 1)])
    r = rows_by(X.export_frame(m, "mindate"))["p1"]
    assert r["priority"] == ""              # T NULL → ''
    assert r["minimentalstate"] is None     # N NULL writes nothing
    assert str(r["totalprice"]) == "12.50000"


def test_numeric_fact_in_cde_column_is_text(spark):
    m = _basic(spark, [(10, "minimentalstate", "N", "E", 12.5, 1)])
    r = rows_by(X.export_frame(m, "mindate"))["p1"]
    assert r["minimentalstate"] == "12.50000"


def test_fact_overrides_demographic(spark):
    m = _basic(spark, [(10, "gender", "T", "X", None, 1)])
    assert rows_by(X.export_frame(m, "mindate"))["p1"]["gender"] == "X"


def test_months_rendering_mindate_vs_longitude(spark):
    m = _basic(spark, [(10, "priority", "T", "x", None, 1)], visits=[(10, 1, 0, 65.58, "MRI")])
    assert rows_by(X.export_frame(m, "mindate"))["p1"]["subjectage"] == "7.00000"
    assert rows_by(X.export_frame(m, "longitude"))["p1"]["subjectage"] == "7"


def test_two_visits_on_first_date_merge(spark):
    visits = [(10, 1, 0, 60.0, "CLINIC"), (12, 1, 0, 70.0, "CLINIC"), (11, 1, 5, 80.0, "CLINIC")]
    facts = [(10, "priority", "T", "low", None, 1), (12, "minimentalstate", "N", "E", 20, 1),
             (11, "totalprice", "N", "E", 1, 1)]
    r = rows_by(X.export_frame(_basic(spark, facts, visits=visits), "mindate"))["p1"]
    assert r["priority"] == "low" and r["minimentalstate"] == "20.00000"
    assert r["totalprice"] is None            # fact of a later visit
    assert r["subjectageyears"] == "70"       # demographics from greatest encounter_num


def test_repeated_concept_takes_greatest_instance(spark):
    facts = [(10, "quantity", "N", "E", 9, 1), (10, "quantity", "N", "E", 3, 2)]
    r = rows_by(X.export_frame(_basic(spark, facts), "mindate"))["p1"]
    assert str(r["quantity"]) == "3.00000"


def test_two_codes_for_one_patient(spark):
    m = _basic(spark, [(10, "priority", "T", "x", None, 1)], codes=[("a", 1), ("b", 1)])
    out = rows_by(X.export_frame(m, "mindate"))
    assert set(out) == {"a", "b"} and out["a"]["priority"] == out["b"]["priority"] == "x"


def _six(spark, diag_days, texts=None, **kw):
    visits = [(1, 1, 0, 65.0, "MRI")]
    facts = []
    for i, d in enumerate(diag_days):
        e = 100 + i
        visits.append((e, 1, d, 66.0, "CLINIC"))
        facts.append((e, "DIAG_etiology_1", "T", (texts or {}).get(d, "Alzheimer"), None, 1))
    return make_mart(spark, [(1, "M")], visits, facts, **kw)


def _diag_day(spark, m, opts):
    tt = X.six_month_selection(m, opts).collect()
    if not tt:
        return None
    return (tt[0].diag_date - tt[0].mri_date).days


def test_window_edges(spark):
    m = _six(spark, [31, 180, 181])
    assert _diag_day(spark, m, X.DEFAULT) == 31
    assert _diag_day(spark, _six(spark, [181]), X.DEFAULT) is None
    assert _diag_day(spark, _six(spark, [180]), X.DEFAULT) == 180
    assert _diag_day(spark, _six(spark, [30, 31]), X.AS_CODED) == 30   # 30 days = 180 × 4 h
    assert _diag_day(spark, _six(spark, [31]), X.AS_CODED) is None


def test_near_and_far_diagnosis(spark):
    m = _six(spark, [5, 25])
    assert _diag_day(spark, m, X.DEFAULT) == 5
    assert _diag_day(spark, m, X.AS_CODED) == 25


def test_na_diagnosis(spark):
    m = _six(spark, [5], texts={5: "NA"})
    assert _diag_day(spark, m, X.DEFAULT) is None
    assert _diag_day(spark, m, X.AS_CODED) == 5


def test_pending_pattern_is_case_sensitive(spark):
    assert _diag_day(spark, _six(spark, [5], texts={5: "Diagnostic en attente"}), X.DEFAULT) is None
    assert _diag_day(spark, _six(spark, [5], texts={5: "diagnostic en attente"}), X.DEFAULT) == 5


def test_diagnosis_in_mri_encounter_only(spark):
    m = make_mart(spark, [(1, "M")], [(1, 1, 0, 65.0, "MRI")],
                  [(1, "DIAG_etiology_1", "T", "Alzheimer", None, 1)])
    assert X.export_frame(m, "6months").count() == 0


def test_mri_value_wins_over_diagnosis_value(spark):
    visits = [(1, 1, 0, 65.0, "MRI"), (2, 1, 3, 65.0, "CLINIC")]
    facts = [(2, "DIAG_etiology_1", "T", "AD", None, 1), (1, "priority", "T", "mri", None, 1),
             (2, "priority", "T", "diag", None, 1), (2, "totalprice", "N", "E", 7, 1),
             (1, "quantity", "T", "", None, 1), (2, "quantity", "T", "filled", None, 1)]
    r = rows_by(X.export_frame(make_mart(spark, [(1, "M")], visits, facts), "6months"))["p1"]
    assert r["priority"] == "mri" and str(r["totalprice"]) == "7.00000"
    assert r["quantity"] == "filled"   # first non-empty wins
    assert r["DIAG_etiology_1"] == "AD"


def test_cognitive_visit_closest_to_diagnosis(spark):
    visits = [(1, 1, 0, 65.0, "MRI"), (2, 1, 10, 65.0, "CLINIC"), (3, 1, 12, 65.0, "CLINIC"),
              (4, 1, 30, 65.0, "CLINIC")]
    facts = [(2, "DIAG_etiology_1", "T", "AD", None, 1), (3, "minimentalstate", "N", "E", 27, 1),
             (4, "minimentalstate", "N", "E", 12, 1)]
    tt = X.six_month_selection(make_mart(spark, [(1, "M")], visits, facts), X.DEFAULT).first()
    assert tt.encounter_num_mmse == 3 and tt.encounter_num_moca is None


def test_shared_visit_code_no_cross_contamination(spark):
    visits = [(10, 1, 0, 60.0, "MRI"), (20, 2, 0, 60.0, "MRI")]
    facts = [(10, "priority", "T", "one", None, 1), (20, "priority", "T", "two", None, 1)]
    m = make_mart(spark, [(1, "F"), (2, "M")], visits, facts, enc_codes={10: "V1", 20: "V1"})
    out = {(r.subjectcode, r.subjectvisitid): r.priority
           for r in X.export_frame(m, "longitude").collect()}
    assert out == {("p1", "V1"): "one", ("p2", "V1"): "two"}


def test_underscore_and_dotted_concepts(spark):
    facts = [(10, "a_b", "T", "u", None, 1), (10, "a.b", "T", "d", None, 1)]
    m = _basic(spark, facts, cdes=("aXb",) + tuple(c for c in X.DEMOGRAPHICS))
    df = X.export_frame(m, "mindate")
    assert {"aXb", "a_b", "a.b"} <= set(df.columns)
    r = rows_by(df)["p1"]
    assert r["a_b"] == "u" and r["a.b"] == "d" and r["aXb"] is None


def test_null_sex_policies(spark):
    m = _basic(spark, [(10, "priority", "T", "x", None, 1)], patients=[(1, None)])
    with pytest.raises(Exception, match="NULL value in age, gender or dataset"):
        X.export_frame(m, "mindate").collect()
    keep = X.export_frame(m, "mindate", X.with_options(X.DEFAULT, null_policy="keep")).collect()
    assert len(keep) == 1 and keep[0].gender is None
    drop = X.export_frame(m, "mindate", X.with_options(X.DEFAULT, null_policy="drop")).collect()
    assert drop == []


def test_bad_valtype_strict_and_lenient(spark):
    m = _basic(spark, [(10, "priority", "D", "x", None, 1), (10, "totalprice", "N", "E", 1, 1)])
    with pytest.raises(Exception, match="unsupported valtype_cd"):
        X.export_frame(m, "mindate").collect()
    r = rows_by(X.export_frame(m, "mindate", X.with_options(X.DEFAULT, valtype_policy="lenient")))
    assert r["p1"]["priority"] is None and str(r["p1"]["totalprice"]) == "1.00000"


def test_mixed_valtype_concept_is_text(spark):
    visits = [(10, 1, 0, 60.0, "MRI"), (11, 1, 0, 60.0, "MRI")]
    facts = [(10, "score", "N", "E", 3, 1), (11, "score", "T", "high", None, 1)]
    df = X.export_frame(_basic(spark, facts, visits=visits), "mindate")
    assert dict(df.dtypes)["score"] == "string"
    assert rows_by(df)["p1"]["score"] == "high"   # greatest encounter wins


def test_dataset_column_needs_case_sensitive_session(spark):
    m = _basic(spark, [(10, "priority", "T", "x", None, 1)])
    opts = X.with_options(X.DEFAULT, dataset="CLM")
    with pytest.raises(ValueError, match="differs only by case"):
        X.export_frame(m, "mindate", opts)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = X.export_frame(m, "mindate", opts)
        assert df.columns[-1] == "Dataset" and "dataset" in df.columns
        assert df.first()["Dataset"] == "CLM"
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_set_or_append(spark):
    df = spark.createDataFrame([(1, "a")], "k int, Dataset string")
    assert C.set_or_append(df, "Dataset", "z").columns == ["k", "Dataset"]
    assert C.set_or_append(df, "Dataset", "z").first().Dataset == "z"
    assert C.set_or_append(df.drop("Dataset"), "Dataset", "z").columns == ["k", "Dataset"]


def test_export_is_partition_count_invariant(spark):
    facts = [(10, "priority", "T", "a", None, 1), (11, "priority", "T", "b", None, 1),
             (10, "quantity", "N", "E", 4, 1), (10, "quantity", "N", "E", 5, 1)]
    m = _basic(spark, facts)
    a = sorted(map(tuple, X.export_frame(m, "longitude").collect()))
    m2 = m.with_tables(observation_fact=m.observation_fact.repartition(7))
    b = sorted(map(tuple, X.export_frame(m2, "longitude").collect()))
    assert a == b


def test_missing_dataset_constant_fails(spark):
    with pytest.raises(Exception, match="NULL value in age, gender or dataset"):
        X.export_frame(_basic(spark, []), "mindate").collect()


@pytest.mark.parametrize("strategy", ["mindate", "longitude"])
def test_imaging_width_keeps_every_cell_and_the_column_order(spark, strategy):
    visits = [(1, 1, 0, 65.0, "MRI"), (2, 2, 0, 60.0, "MRI")]
    names = [f"vol_{i}" for i in range(150)]
    facts = [(1, n, "N", "E", i, 1) for i, n in enumerate(names)] + [(2, "vol_3", "N", "E", 7, 2), (2, "vol_3", "N", "E", 9, 1)]
    df = X.export_frame(make_mart(spark, [(1, "M"), (2, "F")], visits, facts), strategy)
    rows = {r.subjectcode: r for r in df.collect()}
    one, two = (rows[k] for k in sorted(rows))
    assert [float(one[n]) for n in names] == [float(i) for i in range(150)]
    assert two["vol_3"] == 7 and sum(two[n] is not None for n in names) == 1
    assert df.columns[-150:] == sorted(names)


def test_one_selection_and_one_fact_scan(spark):
    from cohortmart.operators.reshape import Catalog
    from cohortmart.schema import Mart
    from cohortmart.session import scratch_path
    m = make_mart(spark, [(1, "M")], [(1, 1, 0, 65.0, "MRI")], [(1, "priority", "T", "x", None, 1)])
    root = scratch_path(spark, "mart")
    m.write_parquet(root)
    back = Mart.from_parquet(spark, root)
    df = X.export_frame(back, "mindate", catalog=Catalog.collect(back.observation_fact))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("nval_num") and plan.count("Relation [") == 1  # the facts; the selection is a written table


def test_longitudinal_key_held_by_two_encounters(spark):
    visits = [(1, 1, 0, 65.0, "MRI"), (2, 1, 3, 66.0, "CLINIC")]
    m = make_mart(spark, [(1, "M")], visits, [(1, "a", "T", "x", None, 1), (2, "b", "T", "y", None, 1)])
    same = m.with_tables(encounter_mapping=m.encounter_mapping.withColumn("encounter_ide", F.lit("V")))
    with pytest.raises(Exception, match="more than one encounter"):
        X.export_frame(same, "longitude").collect()
    rows = X.export_frame(same, "longitude", X.with_options(X.DEFAULT, key_policy="merge")).collect()
    assert len(rows) == 1 and (rows[0].a, rows[0].b) == ("x", "y")


def test_hashed_ids_choose_on_raw_ids(spark):
    import hashlib
    visits = [(1, 1, 0, 65.0, "MRI"), (2, 1, 0, 66.0, "CLINIC")]
    m = make_mart(spark, [(1, "M")], visits, [(1, "a", "T", "x", None, 1), (2, "a", "T", "y", None, 1)])
    plain, = X.export_frame(m, "mindate").collect()
    df = X.export_frame(m, "mindate", X.with_options(X.DEFAULT, hash_ids="md5"))
    hashed, = df.collect()
    assert hashed.subjectcode == hashlib.md5(plain.subjectcode.encode()).hexdigest() and hashed.a == plain.a == "y"
    assert df._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1


def test_hot_encounter_is_split_by_aqe_and_result_unchanged(spark):
    # encounter 10 holds a third of all facts
    visits = [(10, 1, 0, 65.0, "MRI")] + [(100 + i, 2 + i % 40, i % 7, 60.0, "CLINIC")
                                           for i in range(200)]
    patients = [(1, "F")] + [(2 + i, "M") for i in range(40)]
    facts = [(10, f"c{i % 9}", "N", "E", i, i) for i in range(600)]
    facts += [(100 + i % 200, f"c{i % 9}", "T", f"t{i}", None, 1) for i in range(1200)]
    m = make_mart(spark, patients, visits, facts)
    expected = sorted(map(tuple, X.export_frame(m, "longitude").collect()))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = X.export_frame(m, "longitude")
        got = sorted(map(tuple, df.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected
    assert "SortMergeJoin(skew=true)" in plan


def test_column_order_is_key_cdes_by_upload_then_concepts(spark):
    m = make_mart(spark, [(1, "M")], [(1, 1, 0, 65.0, "MRI")], [(1, "zeta", "T", "x", None, 1), (1, "alpha", "N", "E", 2, 1)])
    cd = spark.createDataFrame([("second", "CDE", 2), ("gender", "CDE", 1), ("local", "LOCAL", 0), ("third", "CDE", 3)],
                               "concept_cd string, sourcesystem_cd string, upload_id int")
    df = X.export_frame(m.with_tables(concept_dimension=cd), "mindate")
    assert df.columns == ["subjectcode", "gender", "second", "third", "subjectageyears", "subjectage", "dataset", "agegroup", "alpha", "zeta"]


def test_longitudinal_facts_travel_without_the_codes(spark):
    visits = [(1, 1, 0, 65.0, "MRI"), (2, 1, 3, 66.0, "CLINIC")]
    facts = [(1, "a", "N", "E", 5, 1), (1, "a", "N", "E", 4, 2), (2, "a", "T", None, None, 1), (2, None, "D", "x", None, 1)]
    df = X.export_frame(make_mart(spark, [(1, "M")], visits, facts), "longitude")
    assert sorted((r.subjectvisitid, r.a) for r in df.collect()) == [("v1", "4.00000"), ("v2", "")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    reduced = [line for line in plan.splitlines() if "Aggregate [" in line and "concept_cd" in line.split("]")[0]]
    assert reduced and all("__row" in line.split("]")[0] and "__k" not in line.split("]")[0] for line in reduced)
