"""Operator 10 against all windows of all documents in plain Python."""

import pytest
from pyspark.sql import functions as F

from provisio.llm import line_dedup as ld

SPACE = " \t\n\x0b\x0c\r"


def brute_windows(text, min_lines, min_words):
    lines = [(i, x.strip(SPACE)) for i, x in enumerate((text or "").split("\n")) if x.strip(SPACE)]
    for s in range(len(lines)):
        part, words = [], 0
        for i, x in lines[s:]:
            part.append((i, x))
            words += len([w for w in __import__("re").split("[ \t\n\x0b\x0c\r]+", x) if w])
            if len(part) >= min_lines or words >= min_words:
                yield part[0][0], part[-1][0] + 1, tuple(x for _, x in part)
                break


def brute(rows, min_lines=3, min_words=50):
    """rows: (doc_id, tie, text) -> {(doc_id, tie): text without its later repeats}."""
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    first, out = {}, {}
    for doc_id, tie, text in rows:
        lost = set()
        for a, b, content in brute_windows(text, min_lines, min_words):
            origin = first.setdefault(content, (doc_id, tie, a, b))
            if origin[:2] != (doc_id, tie) or a >= origin[3]:
                lost |= set(range(a, b))
        out[(doc_id, tie)] = text if text is None or not lost else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lost)
    return out


def compare(docs, **size):
    tied = docs.withColumn("own_tie", F.xxhash64("text"))
    want = brute([(r.doc_id, r.own_tie, r.text) for r in tied.collect()], **size)
    got = ld.dedup_lines(tied, **size).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.text == want[(r.doc_id, r.own_tie)]
    return got


@pytest.mark.parametrize("size", [{}, {"min_lines": 2, "min_words": 10 ** 9}, {"min_lines": 10 ** 9, "min_words": 12}])
def test_equals_all_windows(documents, size):
    got = compare(documents, **size)
    assert sum(r.removed_lines > 0 for r in got) > 5


def test_edge_rows(edge, empty):
    got = compare(edge)
    assert set(edge.columns) <= set(got[0].asDict())
    prose = [r for r in got if r.doc_id in (1, 2) and r.lang == "en"]
    assert sorted(r.removed_lines for r in prose) == [0, 0, 0, 3]          # both rows of document 1 keep their lines
    assert ld.dedup_lines(empty).count() == 0


def test_runs_inside_and_across_documents(spark):
    line = [f"line number {i} has its own words" for i in range(40)]
    rows = [(1, "\n".join(line[:10])), (2, "\n".join(["intro here"] + line[3:8] + ["", "outro"])),      # a run of five
            (3, "\n".join(line[0:2] + ["z"] + line[4:6])),                                             # runs too short
            (4, "\n".join(["same words"] * 9 + ["end"])),                                              # repeats of itself
            (5, " ".join(f"long{i}" for i in range(60))), (6, "own start\n" + " ".join(f"long{i}" for i in range(60)) + "\nown end")]
    got = {r.doc_id: r for r in compare(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got[2].text == "intro here\n\noutro" and [tuple(s) for s in got[2].removed_runs] == [(1, 6)]
    assert got[3].removed_lines == 0 and got[1].removed_lines == 0
    assert got[4].text == "\n".join(["same words"] * 3 + ["end"])
    assert got[6].text == "own start\nown end"


def test_a_common_passage_is_joined_to_its_first_place_only(spark):
    passage = "\n".join(f"shared line {i} of the passage" for i in range(4))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), F.col("id").cast("string"), F.lit("\n" + passage)).alias("text"))
    got = ld.dedup_lines(docs).collect()
    assert sorted(r.removed_lines for r in got) == [0] + [4] * 399
