"""Line de-duplication by winnowing over line hashes (operator 10).

A run is a stretch of lines with at least ``min_lines`` lines or ``min_words``
words. From every line starts the shortest such stretch, a window; the window
selects its smallest line hash (the rightmost on ties). Equal windows select
the same line, so any repeated run shares a selected fingerprint.

``dedup_runs`` (the query and the pipeline) has no least number of lines, only
a noise floor of ``RUN_WORDS`` words: a line with that many words is a window of
its own, shorter ones are taken with their neighbours. There a window also ends
at every line, so a short line at the end of a repeated run goes with the run,
and the union of the windows with an earlier place is every line of every
stretch of ``RUN_WORDS`` words that is equal to an earlier one. Blank lines
between two deleted neighbours go with them.
``dedup_lines`` takes both sizes and windows from line starts only.

1. The places of equal fingerprints are counted over all documents. A
   fingerprint is the selected hash together with the digest of its window: the
   hash alone is no proof for a short line (``}`` stands in many contexts, and
   its first place need not be the first place of the run around it).
2. The first place of a fingerprint is its smallest (doc_id, text hash, line);
   every other place joins that one place. A common passage is never paired
   with itself, and a passage that a third of all documents share is joined
   through a broadcast of the at most ``HOT_PLACES`` hottest fingerprints.
3. A match is extended both ways over neighbouring lines as long as the window
   there has an earlier place too; the union is the maximal repeated run.
4. Later runs are deleted; the first place stays. Inside one document a run
   that overlaps its first place is no repeat of it.

Blank lines are not part of runs; those inside a deleted run go with it.

Edge cases: a null text stays null, an empty text stays empty, a text whose
lines are all repeats becomes empty (the row stays). Lines compare without
outer white space. Rows with the same doc_id and text are one document: they
lose the same lines. Null doc_ids come first, ties go by the text's hash. A
very long text, or one of very many lines, is one row of one task. An empty table gives no rows.
Extra columns are carried along; columns of the result's names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpoint_dir
from .common import ASCII_SPACE, fresh, land, map_batches, utf8

MIN_LINES = 3
MIN_WORDS = 50
NO_LINES = 1 << 31  # no number of lines alone makes a run
HOT_PLACES = 1000
RUN_WORDS = 5       # noise floor of dedup_runs: shorter repeats ("Yes.", "}", "Read more") stay


def windows(text: bytes, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
            both_ways: bool = False) -> Iterator[tuple[int, int, int, bytes]]:
    """(selected line hash, first line, end line, content) of every window;
    ``both_ways``: also the shortest stretch that ends at each line."""
    from xxhash import xxh3_128_digest, xxh64_intdigest

    at, hashes, sizes = [], [], []
    for i, line in enumerate(text.split(b"\n")):
        bare = line.strip(ASCII_SPACE)
        if bare:
            at.append(i)
            hashes.append(xxh64_intdigest(bare))
            sizes.append(len(bare.split()))
    n, end, words = len(at), 0, 0
    spans = []
    for start in range(n):
        while end < n and end - start < min_lines and words < min_words:
            words += sizes[end]
            end += 1
        if end - start < min_lines and words < min_words:
            break
        spans.append((start, end))
        words -= sizes[start]
    if both_ways:
        known, start, words = set(spans), 0, 0
        for end in range(1, n + 1):
            words += sizes[end - 1]
            while end - start > min_lines or words - sizes[start] >= min_words:
                words -= sizes[start]
                start += 1
            if (end - start >= min_lines or words >= min_words) and (start, end) not in known:
                spans.append((start, end))
    for start, end in spans:
        inside = hashes[start:end]
        content = xxh3_128_digest(b"".join(h.to_bytes(8, "big") for h in inside))
        yield min(inside), at[start], at[end - 1] + 1, content


_SELECTED = "array<struct<hash: long, windows: array<struct<first: int, stop: int, content: binary>>>>"


def selected_windows(docs: DataFrame, *, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
                     both_ways: bool = False) -> DataFrame:
    """One row per document with windows: doc_id, tie (text hash), picks —
    selected hashes with the windows that select them."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tie long, picks {_SELECTED}"

    def run(batches):
        for b in batches:
            out = {"doc_id": [], "tie": [], "picks": []}
            for doc_id, tie, text in zip(b["doc_id"], b["tie"], b["body"]):
                picks: dict[int, list[dict]] = {}
                for h, first, stop, content in windows(text, min_lines, min_words, both_ways):
                    picks.setdefault(h, []).append({"first": first, "stop": stop, "content": content})
                if picks:
                    out["doc_id"].append(doc_id)
                    out["tie"].append(tie)
                    out["picks"].append([{"hash": h - (1 << 64) if h >> 63 else h, "windows": w} for h, w in picks.items()])
            yield out

    return map_batches(docs.select("doc_id", F.xxhash64("text").alias("tie"), utf8().alias("body")), run, schema)


def _merged(spans: Column, lines: Column | None = None) -> Column:
    """Sorted (first, stop) spans with overlapping and touching ones joined;
    given the text's lines, also those with only blank lines between them."""
    empty = F.array().cast("array<struct<first:int,stop:int>>")

    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        stop = F.try_element_at(acc, F.lit(-1))["stop"]
        touch = stop >= s["first"]
        if lines is not None:
            touch |= F.forall(F.slice(lines, stop + 1, F.greatest(s["first"] - stop, F.lit(0))),
                              lambda x: F.btrim(x, F.lit(ASCII_SPACE.decode())) == "")
        return F.when((F.size(acc) > 0) & touch,
                      F.concat(F.slice(acc, 1, F.size(acc) - 1),
                               F.array(F.struct(last["first"].alias("first"), F.greatest(last["stop"], s["stop"]).alias("stop"))))) \
            .otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, add)


def repeated_runs(docs: DataFrame, *, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
                  both_ways: bool = False) -> DataFrame:
    """doc_id, tie, runs: the maximal later repeats (first line, end line)."""
    checkpoint_dir(docs.sparkSession)
    picked = land(selected_windows(docs, min_lines=min_lines, min_words=min_words, both_ways=both_ways).distinct(), "line-windows")
    places = (picked.select("doc_id", "tie", F.explode("picks").alias("pick")).select("doc_id", "tie", "pick.*")
              .select("doc_id", "tie", "hash", F.explode("windows").alias("w")).select("doc_id", "tie", "hash", "w.*"))
    place = F.struct("doc_id", "tie", "first", "stop")
    firsts = land(places.groupBy("hash", "content").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("places"))
                  .where(F.col("places") > 1), "first-places")
    # fingerprints with over 1 / HOT_PLACES of all repeats, so at most HOT_PLACES, are broadcast: no key is hot in the join
    total = firsts.agg(F.coalesce(F.sum("places"), F.lit(0))).first()[0]
    is_hot = F.col("places") > total / HOT_PLACES
    hot, other = firsts.where(is_hot).drop("places"), firsts.where(~is_hot).drop("places")
    key = ["hash", "content"]
    joined = places.join(F.broadcast(hot), key).unionByName(places.join(F.broadcast(hot.select(*key)), key, "left_anti").join(other, key))
    same_doc = F.col("doc_id").eqNullSafe(F.col("origin.doc_id")) & (F.col("tie") == F.col("origin.tie"))
    later = joined.where(~same_doc | (F.col("first") >= F.col("origin.stop")))
    return (later.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("first", "stop")).alias("spans"))
            .select("doc_id", "tie", _merged(F.col("spans")).alias("runs")))


def dedup_lines(docs: DataFrame, *, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS,
                both_ways: bool = False) -> DataFrame:
    """``docs`` with later repeated runs deleted from ``text``; removed_lines
    counts the lines (blank ones included) and removed_runs locates them."""
    runs = repeated_runs(docs, min_lines=min_lines, min_words=min_words, both_ways=both_ways)
    own = docs.drop("removed_lines", "removed_runs")
    rid, rtie, rruns = fresh(own, "runs_doc_id", "runs_tie", "runs_found")
    found = runs.select(F.col("doc_id").alias(rid), F.col("tie").alias(rtie), F.col("runs").alias(rruns))
    joined = own.join(found, F.col("doc_id").eqNullSafe(F.col(rid)) & (F.xxhash64("text") == F.col(rtie)), "left")
    if both_ways:
        joined = joined.withColumn(rruns, _merged(F.col(rruns), F.split("text", "\n")))
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.exists(rruns, lambda s: (s["first"] <= i) & (i < s["stop"])))
    lost = F.aggregate(rruns, F.lit(0), lambda acc, s: acc + s["stop"] - s["first"])
    return (joined.withColumn("text", F.when(F.col(rruns).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text")))
            .withColumn("removed_lines", F.coalesce(lost, F.lit(0)))
            .withColumn("removed_runs", F.coalesce(F.col(rruns), F.array().cast("array<struct<first:int,stop:int>>")))
            .select(*own.columns, "removed_lines", "removed_runs"))


def dedup_runs(docs: DataFrame, *, min_words: int = RUN_WORDS) -> DataFrame:
    """``dedup_lines`` for every repeated run from one line on, down to a noise
    floor of ``min_words`` words."""
    return dedup_lines(docs, min_lines=NO_LINES, min_words=min_words, both_ways=True)
