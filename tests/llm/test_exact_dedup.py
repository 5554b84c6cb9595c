"""Operator 13 against a dictionary of texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from provisio.llm import exact_dedup as ed
from provisio.llm.queries import QUERIES
from llm.conftest import SMOKE

SPACE = re.compile("[\x20\x09-\x0D]")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[SPACE.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = Counter()
    for body, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for i, m in enumerate(members):
            out[(m[3], members[0][3], len(members), i == 0, hashlib.sha256(body.encode()).hexdigest())] += 1
    return out


def result(df):
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return Counter(map(tuple, df.collect()))


def test_query(spark, rows):
    assert result(QUERIES["op13_exact_dedup"](spark, SMOKE)) == brute([(r["doc_id"], r["text"]) for r in rows])


@pytest.mark.parametrize("run_keys, spare, hot", [(64, 8, 10_000), (1, 0, 10), (2, -5, 1)])
def test_random_copies(spark, monkeypatch, run_keys, spare, hot):
    """Also with many owners, with fingerprints so short that most rows are suspects, and without hot groups."""
    monkeypatch.setattr(ed, "RUN_KEYS", run_keys)
    monkeypatch.setattr(ed, "SPARE_BITS", spare)
    monkeypatch.setattr(ed, "HOT_GROUPS", hot)
    rng = random.Random(run_keys)
    bodies = [f"text number {i} with words" for i in range(300)] + ["", " ", "\t\n", "é è", "東 京"]
    rows = []
    for _ in range(700):
        body = rng.choice([None, *bodies])
        rows.append((rng.choice([None, *range(500)]), body and body.replace(" ", rng.choice([" ", "  ", "\n", ""]))))
    rows += [(5000 + i, "one text that a third of all rows hold") for i in range(350)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(ed.duplicate_groups(docs)) == brute(rows)


def test_edge_rows(spark, edge, empty):
    assert result(ed.duplicate_groups(edge)) == brute([(r.doc_id, r.text) for r in edge.collect()])
    assert result(ed.duplicate_groups(empty)) == Counter()
    alone = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert result(ed.duplicate_groups(alone)) == brute([(None, None)])


def test_deduplicate_keeps_one_whole_row_of_each_text(edge, documents):
    for docs in (edge, documents):
        kept = ed.deduplicate(docs)
        assert kept.columns == docs.columns
        own = Counter(map(tuple, docs.collect()))
        got = Counter(map(tuple, kept.collect()))
        assert got <= own
        bodies = [SPACE.sub("", r[docs.columns.index("text")] or "") for r in got.elements()]
        assert sorted(bodies) == sorted({SPACE.sub("", r[docs.columns.index("text")] or "") for r in own})
        want = {k[1] for k in brute([(r.doc_id, r.text) for r in docs.collect()])}
        assert {r[docs.columns.index("doc_id")] for r in got} == want


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 1 << 40), min_size=1, max_size=300), st.integers(0, 40))
def test_runs_round_trip(values, bits):
    keys = np.array(sorted(values), dtype=np.int64)
    if int(keys[-1]) >> bits > 1 << 20:
        bits = ed.rice_bits(1 << 41, len(keys))
    assert ed.decode_run(*ed.encode_run(keys, bits), bits, len(keys)).tolist() == keys.tolist()


def test_runs_are_near_the_entropy():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 30, 8000))
    rice = ed.rice_bits(1 << 30, len(keys))
    size = 8 * sum(map(len, ed.encode_run(keys, rice))) / len(keys)
    assert size < np.log2((1 << 30) / len(keys)) + 1.6


def test_only_suspects_are_shuffled_with_their_text(spark):
    """Distinct texts raise no flag but for short fingerprints that agree by chance."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("own text "), F.col("id")).alias("text")).repartition(6)
    unique, suspects, groups, n = ed._verified(docs)
    assert n == 4000 and suspects.count() < 4000 / 2**ed.SPARE_BITS * 4 and unique.count() + suspects.count() == 4000
    exchanges = [x for x in unique._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x and "body" in x]
    assert not exchanges
