"""Operator 8 against plain slices of neighbouring texts."""

import hashlib
import random
from collections import Counter

import pytest

from provisio.llm import merkle


def brute(rows):
    """rows in document order: (doc_id, text) -> Counter of the result."""
    texts = [t or "" for _, t in rows]
    out = Counter()
    for (doc_id, _), own, after in zip(rows, texts, texts[1:] + texts[:1]):
        half = len(own) // 2
        edited = own[:len(own) - half] + after[:half]
        a, e, b = merkle.fingerprint(own), merkle.fingerprint(edited), merkle.fingerprint(after)
        out[(doc_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), a, e, merkle.likeness(a, e), merkle.likeness(a, b))] += 1
    return out


def result(df):
    return Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect())


@pytest.mark.parametrize("blocks", [None, 1, 7])
def test_successors_and_fingerprints(documents, rows, blocks):
    got = result(merkle.fingerprint_edits(documents, blocks=blocks))
    assert got == brute(sorted((r["doc_id"], r["text"]) for r in rows))


def test_edge_rows(spark, edge, empty):
    from pyspark.sql import functions as F

    ordered = edge.select("doc_id", "text", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("tie")) \
        .orderBy(F.col("doc_id").asc_nulls_first(), "tie").collect()
    for blocks in (None, 1, 3):
        assert result(merkle.fingerprint_edits(edge, blocks=blocks)) == brute([(r.doc_id, r.text) for r in ordered])
    assert merkle.fingerprint_edits(empty).count() == 0
    alone = spark.createDataFrame([(4, "one two. three")], "doc_id long, text string")
    assert result(merkle.fingerprint_edits(alone)) == brute([(4, "one two. three")])


@pytest.mark.parametrize("hot_id, same_text", [(None, False), (None, True), (5, False), (5, True), (1, True), (300, False)])
def test_hot_ids_are_cut_into_blocks_of_even_size(spark, hot_id, same_text):
    """A third of all rows under one id (or none), with texts of their own or copies."""
    from pyspark.sql import functions as F

    rng = random.Random(4)
    text = lambda: " ".join(f"w{rng.randrange(50)}" for _ in range(8))
    rows = [(i, text()) for i in range(1, 301) if i != hot_id] + [(hot_id, "a copy. of a text" if same_text else text()) for _ in range(150)]
    rows += [(9, "a repeated row")] * 2
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    slim = docs.select("doc_id", F.col("text").cast("binary").alias("body")).withColumn("tie", F.xxhash64("body"))
    dealt, blocks = merkle._dealt(slim.select("doc_id", "body", "tie"), 12)
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 3 * len(rows) / 12 and sum(sizes) <= len(rows) + 2 * blocks
    ordered = slim.select("doc_id", "tie", F.col("body").cast("string").alias("text")).orderBy(F.col("doc_id").asc_nulls_first(), "tie").collect()
    want = brute([(r.doc_id, r.text) for r in ordered])
    for n in (1, 4, 12, 40):
        assert result(merkle.fingerprint_edits(docs, blocks=n)) == want


def test_likeness_and_edit_place():
    rng = random.Random(2)
    line = lambda: " ".join(f"w{rng.randrange(10 ** 6)} w{rng.randrange(10 ** 6)}." for _ in range(4))
    lines = [line() for _ in range(40)]
    a = merkle.fingerprint("\n".join(lines))
    changed = lines[:20] + [lines[20].replace("w", "v", 1)] + lines[21:]
    b = merkle.fingerprint("\n".join(changed))
    assert a != b and merkle.likeness(a, a) == 1.0 and 0.99 < merkle.likeness(a, b) < 1.0
    assert merkle.edited_leaves(a, b) == (80, 81, 81)
    inserted = merkle.fingerprint("\n".join(lines[:5] + [line()] + lines[5:]))
    assert merkle.edited_leaves(a, inserted) == (20, 20, 24)
    assert merkle.likeness(a, merkle.fingerprint("\n".join(line() for _ in range(40)))) == 0.0
    assert merkle.likeness(a, b) == merkle.likeness(b, a)


def test_equal_roots_only_for_equal_texts():
    texts = ["", " ", "\n", "a", "a\n", "a. b", "a.\nb", "a\n\nb", "a.  b", "a. b\n"]
    assert len({merkle.fingerprint(t).split(":")[0] for t in texts}) == len(texts)


def test_a_line_without_full_stops_is_cut_by_content():
    rng = random.Random(8)
    words = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 6) + str(rng.randrange(999)) for _ in range(400)) for _ in range(3)]
    for a, b in zip(words, words[1:]):
        half = len(a) // 2
        near = merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(a[:len(a) - half] + b[:half]))
        assert 0.35 < near < 0.65
        assert merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) < 0.05
    script = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(2000))
    assert merkle.likeness(merkle.fingerprint(script), merkle.fingerprint(script[:900] + "x" + script[901:])) > 0.85
    inserted = merkle.likeness(merkle.fingerprint(words[0]), merkle.fingerprint(words[0][:700] + " put in " + words[0][700:]))
    assert inserted > 0.8
