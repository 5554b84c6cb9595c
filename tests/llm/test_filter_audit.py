"""Operator 12 against filters applied one after another, in all orders."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

from provisio.llm import filter_audit as fa
from provisio.llm.queries import QUERIES
from llm.conftest import SMOKE, table

WORD = re.compile("[^\x20\x09-\x0D]+")
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failing(text, doc_id, ids_of):
    words = WORD.findall(text)
    return {c for c, f in zip("ABCDE", (
        len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        re.search("[#$%&*|]", text) is not None, doc_id is not None and any(d < doc_id for d in ids_of[text]))) if f}


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    ids_of, parts = defaultdict(set), defaultdict(list)
    for d, t, _ in docs:
        if d is not None:
            ids_of[t or ""].add(d)
    for d, t, s in docs:
        parts[s or ""].append((d, failing(t or "", d, ids_of)))
    out = {}
    for part, rows in parts.items():
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, c in enumerate(order, 1):
                lost = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                total[c] += len(lost)
                out[(part, order, step)] = [len(left), len(lost), sum(c in f for _, f in rows) - len(lost), sum(f == {c} for _, f in rows),
                                            sum(d in good for d, _ in lost), sum(d in toxic for d, _ in lost)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(total[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


def test_query(spark):
    got = QUERIES["op12_filter_audit"](spark, SMOKE)
    assert got.columns == COLUMNS
    docs = [(r["doc_id"], r["text"], r["source"]) for r in table("documents")]
    want = brute(docs, [(r["doc_id"], r["quality"], r["toxic"]) for r in table("labels")])
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(want) and set(got) == want


def test_edge_rows(spark, edge, empty):
    rng = random.Random(12)
    texts = ["", None, " \t", "A B C", "few words only", "# mark", " ".join(f"word{i}" for i in range(60)), "same " * 80, "CAPS " * 60,
             "x" * 200_000, "é" * 30 + " É" * 60]
    rows = [(rng.choice([None, *range(25)]), rng.choice(texts), rng.choice([None, "", "a", "b"])) for _ in range(250)]
    rows += [(None, "a text that many rows without an id share", "hot")] * 100
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    marks = [(rng.choice([None, *range(30)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in fa.filter_interactions(docs, labels).collect()]
    want = brute(rows, marks)
    assert len(got) == len(want) and set(got) == want
    clashing = [tuple(r) for r in fa.filter_interactions(edge, labels).collect()]
    assert set(clashing) == brute([(r.doc_id, r.text, r.source) for r in edge.collect()], marks)
    assert fa.filter_interactions(empty, labels).count() == 0
    nothing = spark.createDataFrame([], labels.schema)
    assert {(r.good_lost, r.toxic_lost) for r in fa.filter_interactions(docs, nothing).collect()} == {(0, 0)}


def test_potentials_share_out_the_whole_removal(spark):
    """Efficiency, and a filter that removes nothing gets nothing."""
    from pyspark.sql import functions as F

    counts = spark.createDataFrame([("p", 0b00011, True, False, 5), ("p", 0b00110, False, True, 7), ("p", 0, False, False, 9)],
                                   "part string, mask int, good boolean, toxic boolean, n long")
    got = fa.audit(counts).where(F.col("filter_order") == "ABCDE").orderBy("step").collect()
    assert sum(r.shapley for r in got) == 120 * 12 and [r.shapley for r in got] == [300, 720, 420, 0, 0]
    assert [(r.removed, r.redundant, r.good_lost, r.toxic_lost) for r in got[:3]] == [(5, 0, 5, 0), (7, 5, 0, 7), (0, 7, 0, 0)]
