"""Operator 10's query: every repeated stretch of lines, by brute force over all
stretches of all documents (no windows)."""

import random

from pyspark.sql import functions as F

from provisio.llm import line_dedup as ld
from provisio.llm.queries import QUERIES
from llm.conftest import SMOKE

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, floor=ld.RUN_WORDS):
    """rows: (doc_id, tie, text) -> {(doc_id, tie): text without its later repeats}."""
    first, out = {}, {}
    for doc_id, tie, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        lines = [(i, x.strip(SPACE)) for i, x in enumerate((text or "").split("\n")) if x.strip(SPACE)]
        lost = set()
        for s in range(len(lines)):
            for e in range(s + 1, len(lines) + 1):
                content = tuple(x for _, x in lines[s:e])
                if sum(len(x.split()) for x in content) >= floor:
                    a, b = lines[s][0], lines[e - 1][0] + 1
                    origin = first.setdefault(content, (doc_id, tie, a, b))
                    if origin[:2] != (doc_id, tie) or a >= origin[3]:
                        lost |= {i for i, _ in lines[s:e]}
        for (i, _), (k, _) in zip(lines, lines[1:]):
            if i in lost and k in lost:
                lost |= set(range(i, k))
        out[(doc_id, tie)] = text if text is None or not lost else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lost)
    return out


def test_equals_all_stretches(spark):
    rng = random.Random(10)
    lines = ["a", "b c", "d e f", "g h i j", "one line of five words", "six words are in this line", "", "  "]
    rows = [(rng.choice([None, *range(60)]), "\n".join(rng.choice(lines) + rng.choice(["", "", f" own {n} {k}"]) for k in range(rng.randrange(0, 14)))) for n in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("own_tie", F.xxhash64("text")).repartition(4)
    want = brute([(r.doc_id, r.own_tie, r.text) for r in docs.collect()])
    got = ld.dedup_runs(docs).collect()
    assert len(got) == len(rows) and sum(r.removed_lines > 0 for r in got) > 50
    assert all(r.text == want[(r.doc_id, r.own_tie)] for r in got)


def test_one_short_line_in_many_documents_stays_once(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), F.col("id"), F.lit("\nthe same line of seven words here\nend "), F.col("id")).alias("text"))
    assert sorted(r.removed_lines for r in ld.dedup_runs(docs).collect()) == [0] + [1] * 299


def test_query_leaves_no_repeated_line_of_the_floor(spark):
    seen = set()
    for r in QUERIES["op10_line_dedup"](spark, SMOKE).collect():
        for x in (r.text or "").split("\n"):
            x = x.strip(SPACE)
            if len(x.split()) >= ld.RUN_WORDS:
                assert x not in seen
                seen.add(x)
