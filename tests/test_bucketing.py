"""Bucketed marts and shared visit codes."""

import os

import pytest

from cohortmart.fixtures import clinical_mart
from cohortmart.plans import export as X
from cohortmart.session import scratch_path

SF = "/root/testdata/sf0.001"
VIS = "PATIENT_ID string, VISIT_ID string, VISIT_DATE string, PATIENT_AGE decimal(18,5)"


def test_bucketed_mart_export_does_not_shuffle_facts(spark):
    if not os.path.isdir(SF):
        return
    m = clinical_mart(spark, SF)
    b = m.save_bucketed("cm_bucket_test", scratch_path(spark, "mart"), 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = X.export_frame(b, "mindate")
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        scan = [i for i, l in enumerate(lines) if "observation_fact" in l and "FileScan" in l]
        assert scan, plan
        # the line above the fact scan is the join, not an Exchange
        assert "Exchange" not in lines[scan[0] - 1]
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, X.export_frame(m, "mindate").collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ingest_reports_shared_visit_ids(spark):
    from decimal import Decimal as D
    from cohortmart.plans.ingest import ingest_imaging
    vols = spark.createDataFrame([("P1_V1", D("1")), ("P2_V1", D("2"))], "subjectcode string, a decimal(18,5)")
    visits = spark.createDataFrame([("P1", "V1", "01/02/2019", D("70")), ("P2", "V1", "01/02/2019", D("60"))], VIS)
    res = ingest_imaging(vols, visits, policy="report")
    assert [r.VISIT_ID for r in res.duplicate_visit_ids.collect()] == ["V1"]
    with pytest.raises(ValueError, match="VISIT_ID"):
        ingest_imaging(vols, visits)
