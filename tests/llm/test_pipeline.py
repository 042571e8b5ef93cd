"""The pipeline stage by stage against brute force, and the registered queries."""

import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from cohortmart.llm import common, pii, quality
from cohortmart.llm import queries as LQ
from tests.llm.test_operators import BYTES_FILE, EXTRA, brute_components, brute_contamination
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_every_operator_has_one_query():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(LQ.ORACLES) <= set(LQ.REGISTRY)


@pytest.mark.parametrize("name", sorted(LQ.ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    rows, orows = [tuple(r) for r in df.collect()], cur.fetchall()
    assert sorted(df.columns) == sorted(names) and len(rows) == len(orows) > 0
    assert digest(df.columns, rows) == digest(names, orows)


def test_stages(spark):
    docs = common.read_table(spark, SF, "documents")
    kept, stages = {}, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "jaccard", "decontamination", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = common.materialize(stage(spark, docs, SF), f"test-{name}")
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.schema.simpleString() == before.schema.simpleString()

    before, after = kept["quality"]
    net = quality.fit(before, common.read_table(spark, SF, "labels"))
    good = {r.doc_id for r in quality.judged(before, net).filter("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == good and len(good) < before.count()

    before, after = (texts(d) for d in kept["jaccard"])
    assert {d for d, _ in after} == {d for d, _, c in brute_components(before, 5, 80) if d == c}
    assert len(after) < len(before)

    before, after = (texts(d) for d in kept["decontamination"])
    bench = [(r.item_id, r.text) for r in common.read_table(spark, SF, "benchmark").collect()]
    hit = {row[0] for row in brute_contamination(before, bench) if row[-1]}
    assert hit and {d for d, _ in after} == {d for d, _ in before} - hit

    before, after = (texts(d) for d in kept["pii"])
    assert Counter(after) == Counter((d, pii.redact(t, pii.find(t)[1])) for d, t in before)
    assert all(r.n_chars == len(r.text) for r in kept["pii"][1].collect())

    before, packed = texts(kept["packing"][0]), kept["packing"][1].collect()
    plain, by_doc, by_sequence = Tokenizer.from_file(BYTES_FILE), defaultdict(dict), defaultdict(list)
    for p in packed:
        by_doc[p.doc_id][p.start] = p
        by_sequence[p.sequence_id].append((p.offset, p.length))
    assert len(by_doc) == len(before)
    for d, t in before:
        ids, at = np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4"), 0
        for start, p in sorted(by_doc[d].items()):
            assert start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length])
            at += p.length
        assert at == len(ids)
    assert all(sum(n for _, n in s) <= 2048 for s in by_sequence.values())


def test_stages_leave_columns_with_clashing_names(spark):
    docs = common.read_table(spark, SF, "documents").limit(60)
    extra = [*EXTRA, "predicted", "gone_id", "gone_h", "h_", "score_", "component_id", "contaminated"]
    for n in extra:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id")))
    docs = common.materialize(docs, "test-clash")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.materialize(stage(spark, docs, SF), "test-clash")
        if name != "packing":
            assert docs.schema.simpleString() == before.schema.simpleString() and 0 < docs.count()
            assert docs.filter(" or ".join(f"`{n}` <> concat('{n}', doc_id)" for n in extra)).count() == 0


def test_stages_on_no_rows_and_on_odd_rows(spark):
    docs = common.read_table(spark, SF, "documents")
    odd = docs.limit(40).unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (900001, "", "en", None, 0), (900001, "", "en", None, 0), (900002, None, None, "s", None)], docs.schema))
    for start in (docs.filter("false"), odd):
        now = common.materialize(start, "test-odd")
        n = now.count()
        for name, stage in corpus_pipeline.STAGES:
            now = common.materialize(stage(spark, now, SF), "test-odd")
        assert (now.count() > 0) == (n > 0)
