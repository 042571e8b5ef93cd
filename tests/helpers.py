"""Tiny hand-written marts for golden tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from cohortmart.schema import Mart

CDES = ("subjectageyears", "subjectage", "gender", "dataset", "agegroup", "DIAG_etiology_1",
        "minimentalstate", "montrealcognitiveassessment")
BASE = dt.datetime(2019, 1, 1)


def day(n: float) -> dt.datetime:
    return BASE + dt.timedelta(days=n)


def make_mart(spark, patients, visits, facts, cdes=CDES, codes=None, enc_codes=None,
              provider="HOSP") -> Mart:
    """patients: [(patient_num, sex)]; visits: [(enc, patient, day, age, location)];
    facts: [(enc, concept, valtype, tval, nval, instance)]; codes: [(ide, patient_num)]."""
    codes = codes if codes is not None else [(f"p{p}", p) for p, _ in patients]
    pm = spark.createDataFrame(
        [(ide, "SRC", "PRJ", p) for ide, p in codes],
        "patient_ide string, patient_ide_source string, project_id string, patient_num long")
    pd = spark.createDataFrame(patients, "patient_num long, sex_cd string")
    vrows = [(e, p, day(d) if d is not None else None,
              Decimal(str(a)) if a is not None else None, loc) for e, p, d, a, loc in visits]
    vd = spark.createDataFrame(vrows, "encounter_num long, patient_num long, start_date timestamp_ntz, "
                                      "patient_age decimal(18,5), location_cd string")
    ide_of = {}
    for ide, p in codes:
        ide_of.setdefault(p, ide)
    enc_codes = enc_codes or {}
    em = spark.createDataFrame(
        [(enc_codes.get(e, f"v{e}"), "SRC", "PRJ", ide_of.get(p), "SRC", e) for e, p, *_ in visits],
        "encounter_ide string, encounter_ide_source string, project_id string, patient_ide string, "
        "patient_ide_source string, encounter_num long")
    vmap = {e: (p, d) for e, p, d, *_ in visits}
    frows = []
    for e, concept, vt, tval, nval, inst in facts:
        p, d = vmap[e]
        frows.append((e, p, concept, provider, day(d), "@", inst, vt, tval,
                      Decimal(str(nval)) if nval is not None else None))
    of = spark.createDataFrame(
        frows, "encounter_num long, patient_num long, concept_cd string, provider_id string, "
               "start_date timestamp_ntz, modifier_cd string, instance_num int, valtype_cd string, "
               "tval_char string, nval_num decimal(18,5)")
    cd = spark.createDataFrame([(c, "CDE", i + 1) for i, c in enumerate(cdes)],
                               "concept_cd string, sourcesystem_cd string, upload_id int")
    return Mart(pm, em, pd, vd, cd, of)


def rows_by(df, key="subjectcode"):
    return {r[key]: r.asDict() for r in df.collect()}
