"""corpus_pipeline.py: every stage against a plain version on its own input."""

from collections import Counter

import corpus_pipeline as cp
import pytest

from llm import test_line_runs, test_mixing, test_pack, test_simhash
from llm.conftest import SMOKE


@pytest.fixture(scope="module")
def stages(spark, documents):
    """Each stage's (input rows, output rows)."""
    from provisio.llm.common import land

    docs, out = documents, {}
    for name, stage in cp.STAGES:
        result = land(stage(spark, docs, SMOKE), "stage")
        out[name] = (docs.collect(), result.collect())
        if name != "packing":
            assert tuple(result.columns) == cp.COLUMNS
        docs = result
    return out


def test_stage_order():
    assert [name for name, _ in cp.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "packing"]


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages["language ID"]
    kept = {r.doc_id for r in after}
    assert all(r.doc_id in kept for r in before if r.text and any(c.isalpha() for c in r.text) and r.n_chars > 200)
    assert Counter(after) <= Counter(before)


def test_line_stage(spark, stages):
    from pyspark.sql import functions as F

    before, after = stages["line dedup"]
    tied = spark.createDataFrame(before).withColumn("tie", F.xxhash64("text")).collect()
    want = test_line_runs.brute([(r.doc_id, r.tie, r.text) for r in tied])
    text = {d: t for (d, _), t in want.items()}
    assert len(after) == len(before)
    assert all(r.text == text[r.doc_id] and r.n_chars == len(r.text) for r in after)


def test_near_duplicate_stage(stages):
    before, after = stages["SimHash near-dedup"]
    want = test_simhash.expected([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in want})
    assert Counter(after) <= Counter(before)


def test_mixing_stage(stages):
    before, after = stages["mixing sources to target weights"]
    want = test_mixing.brute([(r.doc_id, r.text, r.source) for r in before])
    assert Counter((r.doc_id, r.text) for r in after) == Counter((d, t) for d, t, _ in want.elements())


def test_packing_stage(stages):
    before, after = stages["packing"]
    test_pack.check(after, [(r.doc_id, r.text) for r in before])


def test_run_equals_the_stages_and_edge_rows_pass_through(spark, stages, edge, empty):
    assert Counter(map(tuple, cp.run(spark, SMOKE).collect())) == Counter(map(tuple, stages["packing"][1]))
    from pyspark.sql import functions as F

    kept = edge
    for name, stage in cp.STAGES[:3]:
        kept = stage(spark, kept, SMOKE)
    ids = [r.doc_id for r in kept.collect()]
    assert 6 in ids and not {3, 4, 5, 9} & set(ids)          # the very long text stays; null, empty and letterless texts go
    assert ids.count(1) == 1                                 # of the repeated row one stays
    mixed = cp.mix_sources(spark, kept, SMOKE)
    assert {r.doc_id for r in mixed.collect()} <= set(ids)
    pieces = cp.pack_sequences(spark, mixed, SMOKE)
    per = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert per.where("n > 1024 or n <> end").count() == 0 and pieces.count() >= len({r.doc_id for r in mixed.collect()})
    for name, stage in cp.STAGES:
        empty = stage(spark, empty, SMOKE)
    assert empty.count() == 0
