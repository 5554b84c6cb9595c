"""Sequence packing by shortest-pack-first over the length histogram (operator 9).

Documents become token ids plus one end id and are cut into pieces of at most
``size`` tokens (full pieces first, the remainder last). The histogram of
piece lengths (at most ``size`` bins) is packed on the driver: lengths from
the longest down go into the open packs with the most room, a whole run of
equal packs at a time, which yields pattern counts. Every piece gets its rank
within its length by a range shuffle of slim rows, and a small table of
(length, rank range) -> pattern slot turns ranks into sequences.

A sequence is padded to ``size`` unless its length is a power of two.

Edge cases: a null or empty text is the end id alone. A very long text is
encoded whole and cut into as many pieces as it needs. Pieces of equal length
are ranked by (doc_id, start, a hash of the ids), null doc_ids first. Repeated rows and rows
sharing a doc_id are packed one by one. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..operators.ordered import row_number_global
from ..session import checkpoint_dir
from .bpe import broadcast_tokenizer, encoder_of
from .common import land, map_batches, utf8

END_ID = 0
SEQUENCE_TOKENS = 1024

PIECES = "doc_id long, doc_tokens long, start array<long>, length array<long>, ids_crc32 array<long>"


def token_pieces(docs: DataFrame, *, tokenizer_path: str | None = None, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: doc_id, doc_tokens, start, length, ids_crc32."""
    raw = broadcast_tokenizer(docs.sparkSession, tokenizer_path)
    end = np.asarray([END_ID], dtype="<u4").tobytes()
    step = 4 * size

    def cut(batches):
        encode = encoder_of(raw.value).encode
        for b in batches:
            tokens, starts, lengths, crcs = [], [], [], []
            for text in b["text"]:
                ids = memoryview(encode(text) + end)
                tokens.append(len(ids) // 4)
                at = range(0, len(ids), step)
                starts.append([i // 4 for i in at])
                lengths.append([len(ids[i:i + step]) // 4 for i in at])
                crcs.append([zlib.crc32(ids[i:i + step]) for i in at])
            yield {"doc_id": b["doc_id"], "doc_tokens": tokens, "start": starts, "length": lengths, "ids_crc32": crcs}

    per_doc = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")), cut, PIECES)
    return (per_doc.select("doc_id", "doc_tokens", F.explode(F.arrays_zip("start", "length", "ids_crc32")).alias("p"))
            .select("doc_id", "doc_tokens", "p.*"))


def pack_histogram(histogram: dict[int, int], size: int = SEQUENCE_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence, longest first) with their counts.

    Lengths are placed longest first into the packs with the most room left;
    a run of equal packs is filled together, and split if it is longer than
    the lengths that are left."""
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)   # room -> (pattern, count)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            room = max((r for r, packs in open_packs.items() if packs), default=0)
            if room < length:    # no pack can take it: open new ones, with as many as fit in each
                per = size // length
                full, rest = divmod(left, per)
                if full:
                    open_packs[size - per * length].append(((length,) * per, full))
                if rest:
                    open_packs[size - rest * length].append(((length,) * rest, 1))
                break
            pattern, count = open_packs[room].pop()
            used = min(count, left)
            if count > used:
                open_packs[room].append((pattern, count - used))
            open_packs[room - length].append((pattern + (length,), used))
            left -= used
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for packs in open_packs.values():
        for pattern, count in packs:
            merged[pattern] += count
    return sorted(merged.items(), reverse=True)


def pattern_slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): rank r of that
    length sits in sequence ``first sequence + r - first rank``."""
    slots, taken, sequence = [], defaultdict(int), 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            slots.append((length, taken[length], taken[length] + count, sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return slots


def pack(docs: DataFrame, *, tokenizer_path: str | None = None, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """Every piece with its sequence_id and offset; also sequence_tokens, the
    ids in the sequence before padding."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    pieces = land(token_pieces(docs, tokenizer_path=tokenizer_path, size=size), "pieces")
    # at most `size` rows: the bins of the histogram
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = pack_histogram(histogram, size)
    slots = pattern_slots(patterns)
    before, total = {}, 0
    for length in sorted(histogram):
        before[length], total = total, total + histogram[length]
    fill = {s: 0 for s in ()}
    first = 0
    spans = []
    for pattern, count in patterns:
        spans.append((first, sum(pattern)))
        first += count
    fill = dict(spans)
    rows = [(length, before[length] + lo, before[length] + hi, seq, off, fill[seq]) for length, lo, hi, seq, off in slots]
    table = spark.createDataFrame(rows, "slot_length long, lo long, hi long, first_sequence long, offset long, sequence_tokens long")

    # rank over (length, document order): a range shuffle, so a hot length is spread over tasks
    ranked = row_number_global(pieces.withColumn("tie", F.xxhash64("doc_id", "start", "ids_crc32")),
                               ["length", "doc_id", "start", "tie"], out="rank")
    position = F.col("rank") - 1
    # the slot table's size depends on `size` alone (patterns over at most `size` lengths), never on the documents
    return (ranked.join(F.broadcast(table), (F.col("length") == F.col("slot_length"))
                        & (position >= F.col("lo")) & (position < F.col("hi")))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("first_sequence") + position - F.col("lo")).alias("sequence_id"),
                    "offset", "sequence_tokens"))
