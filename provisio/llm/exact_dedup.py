"""Exact de-duplication by Golomb-coded fingerprint exchange (operator 13).

Texts are equal if they are identical without white space (the six ASCII
characters of ``ASCII_SPACE``). Only texts that may have a copy are shuffled:

1. One scan writes every row once to the shared folder with its block (the
   scan's partition), its position there, the text's SHA-256 and a
   fingerprint, bucketed by block, so that later steps find a block's rows in
   place. From here on a lost executor changes nothing.
2. Each block sorts its distinct fingerprints, cuts them by owner (equal ranges
   of the fingerprint) and sends one Golomb-Rice-coded run of gaps to each.
   Copies inside a block are sent once. A fingerprint is as long as the number
   of rows asks for: ``SPARE_BITS`` more than it takes to number them.
3. An owner decodes its runs, finds the fingerprints that came from two blocks
   or more and answers every run with a bitmap in the run's order. Its input
   is an even share of all fingerprints, and no fingerprint comes twice from
   one block, so a text with a third of all rows is one entry a block.
4. A block turns the bitmaps, and its own repeats, into one bit a row: suspect
   or not. The bits meet the written rows by block, without moving a text.
5. Rows without the bit are unique. Suspects' texts are shuffled for byte
   verification: an aggregate on (SHA-256, text) compares whole texts and
   reduces copies in every task before the shuffle. Of each text the row with
   the most code points in the original stays, then the smallest doc_id.
6. Narrow suspect rows join their verified group by its SHA-256. Groups that
   hold over 1 / ``HOT_GROUPS`` of all rows (so at most ``HOT_GROUPS``) are
   broadcast, so no join key is hot.

Edge cases: null texts, empty ones and those of white space only are equal to
each other. A null doc_id loses every tie; if a group has no other, keep_id is
null. Rows that agree in length and doc_id too are told apart by their place in
the written table, and one of them stays. A very long text is one row in one
task; the runs and bitmaps do not depend on lengths. An empty table gives no
rows. Extra columns are ignored by ``duplicate_groups`` and carried by
``deduplicate``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from math import ceil, log

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpoint_dir, scratch_path
from .common import land, ship_package, shuffle_partitions

SPARE_BITS = 8           # at most one row in 2^8 is a suspect by its short fingerprint alone
RUN_KEYS = 64            # fingerprints of a run on average, before there is another owner
OWNER_KEYS = 8 << 20     # fingerprints of an owner at most, on average
HOT_GROUPS = 10_000
SEPARATORS = r"[\x20\x09-\x0D]+"
_PLACE_BITS = 33         # a row's number is its block, then 33 bits of its place there


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, "")


def rice_bits(width: int, count: int) -> int:
    """The Golomb-Rice parameter for ``count`` sorted numbers below ``width``:
    gaps are nearly geometric with mean width / count."""
    mean = max(1.0, width / max(1, count))
    return max(0, ceil(log(mean * log(2), 2))) if mean > 1 else 0


def encode_run(values: np.ndarray, bits: int) -> tuple[bytes, bytes]:
    """Sorted distinct numbers as gaps: unary quotients, then ``bits`` bits of
    each remainder."""
    gaps = np.diff(values, prepend=np.int64(-1)) - 1
    stops = np.cumsum((gaps >> bits) + 1)
    unary = np.zeros(int(stops[-1]) if len(stops) else 0, dtype=bool)
    unary[stops - 1] = True
    low = (gaps[:, None] >> np.arange(bits - 1, -1, -1)) & 1
    return np.packbits(unary).tobytes(), np.packbits(low.astype(bool).ravel()).tobytes()


def decode_run(unary: bytes, low: bytes, bits: int, count: int) -> np.ndarray:
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, dtype=np.uint8)))[:count]
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.int64) << bits
    if bits:
        digits = np.unpackbits(np.frombuffer(low, dtype=np.uint8), count=count * bits).reshape(count, bits).astype(np.int64)
        gaps |= digits @ (np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64))
    return np.cumsum(gaps + 1) - 1


def owner_ranges(bits: int, owners: int) -> np.ndarray:
    """Lower ends of the owners' equal ranges of ``bits``-bit fingerprints."""
    return np.array([(o << bits) // owners for o in range(owners)] + [1 << bits], dtype=np.int64)


def _short(long_prints: np.ndarray, bits: int) -> np.ndarray:
    return (long_prints.astype(np.int64).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


_RUN = "owner int, block int, count int, rice int, unary binary, low binary"
_ANSWER = "block int, owner int, answer binary"
_FLAGS = "block int, flags array<long>"


def coded_runs(prints: DataFrame, bits: int, owners: int) -> DataFrame:
    """(block, place, print) -> one coded run for each block and owner."""
    import pandas as pd

    def send(block):
        keys = np.unique(_short(block["print"].to_numpy(), bits))
        ends = owner_ranges(bits, owners)
        cuts = np.searchsorted(keys, ends)
        out = []
        for o in np.flatnonzero(np.diff(cuts)):
            run = keys[cuts[o]:cuts[o + 1]] - ends[o]
            rice = rice_bits(int(ends[o + 1] - ends[o]), len(run))
            out.append((int(o), int(block["block"].iloc[0]), len(run), rice, *encode_run(run, rice)))
        return pd.DataFrame(out, columns=["owner", "block", "count", "rice", "unary", "low"])

    return prints.groupBy("block").applyInPandas(send, _RUN)


def duplicate_bitmaps(runs: DataFrame) -> DataFrame:
    """Every run's answer: one bit for each of its fingerprints, set if
    another block sent it too."""
    import pandas as pd

    def answer(owned):
        sent = [decode_run(*r) for r in zip(owned["unary"], owned["low"], owned["rice"], owned["count"])]
        keys, times = np.unique(np.concatenate(sent), return_counts=True)
        repeated = keys[times > 1]
        bitmaps = [np.packbits(np.isin(keys, repeated, assume_unique=True)).tobytes() for keys in sent]
        return pd.DataFrame({"block": owned["block"], "owner": owned["owner"], "answer": bitmaps})

    return runs.groupBy("owner").applyInPandas(answer, _ANSWER)


def suspect_flags(prints: DataFrame, bitmaps: DataFrame, bits: int, owners: int) -> DataFrame:
    """One row a block: a bit for each place, in 64-bit words, set if the
    row's fingerprint occurs elsewhere or twice in the block."""
    import pandas as pd

    def mark(block, answers):
        if block.empty:
            return pd.DataFrame({"block": [], "flags": []})
        keys, inverse, times = np.unique(_short(block["print"].to_numpy(), bits), return_inverse=True, return_counts=True)
        cuts = np.searchsorted(keys, owner_ranges(bits, owners))
        repeated = times > 1
        for o, answer in zip(answers["owner"], answers["answer"]):
            lo, hi = cuts[o], cuts[o + 1]
            repeated[lo:hi] |= np.unpackbits(np.frombuffer(answer, dtype=np.uint8), count=hi - lo).astype(bool)
        place = block["place"].to_numpy()
        flags = np.zeros((int(place.max()) // 64 + 1) * 64, dtype=bool)
        flags[place] = repeated[inverse]
        words = np.packbits(flags, bitorder="little").view("<i8")
        return pd.DataFrame({"block": [int(block["block"].iloc[0])], "flags": [words.tolist()]})

    return prints.groupBy("block").cogroup(bitmaps.groupBy("block")).applyInPandas(mark, _FLAGS)


def _write_blocks(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The rows with block, place, row, print, sha, size and body, bucketed by
    block; ``carry`` names columns that go along in a struct."""
    spark = docs.sparkSession
    own = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(True)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("size"),
                        normalised(F.col("text")).alias("body"), F.monotonically_increasing_id().alias("row"), own.alias("carried"))
            .withColumn("block", F.shiftright("row", _PLACE_BITS).cast("int"))
            .withColumn("place", F.col("row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
            .withColumn("print", F.xxhash64("body")).withColumn("sha", F.sha2(F.col("body").cast("binary"), 256)))
    name = f"provisio_blocks_{uuid.uuid4().hex[:12]}"
    (rows.write.bucketBy(shuffle_partitions(spark), "block").option("path", scratch_path(spark, "blocks"))
     .option("compression", "zstd").saveAsTable(name))
    written = spark.table(name)
    written.schema                                  # resolved: the name is not needed any more
    spark.sql(f"DROP TABLE {name}")                 # an external table: its files stay
    return written


def _verified(docs: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(unique rows, suspect rows, verified groups of the suspects, number of rows)."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    ship_package(spark)
    rows = _write_blocks(docs, carry)
    n, blocks = rows.agg(F.count(F.lit(1)), F.count_distinct("block")).first()
    bits = min(62, n.bit_length() + SPARE_BITS)
    owners = max(1, ceil(n / OWNER_KEYS), min(shuffle_partitions(spark), n // max(1, blocks) // RUN_KEYS))
    prints = rows.select("block", "place", "print")
    bitmaps = duplicate_bitmaps(coded_runs(prints, bits, owners))
    flags = land(suspect_flags(prints, bitmaps, bits, owners), "suspect-flags")
    of = F.get("flags", F.shiftright("place", 6).cast("int"))
    marked = rows.join(flags.hint("shuffle_hash"), "block") \
        .withColumn("suspect", F.getbit(of, F.col("place").bitwiseAND(F.lit(63)).cast("int")) == 1)
    suspects = marked.where("suspect")
    # most code points first, then the smallest id, null ids last: one fixed-width number
    number = lambda c: c.cast("decimal(38,0)")
    rank = number(F.col("size") * number(F.lit(10**10)) * number(F.lit(10**10))) - F.coalesce(number(F.col("doc_id")), number(F.lit(str(1 << 63))))
    groups = (suspects.select("sha", "body", "doc_id", "row", number(rank).alias("rank"))
              .groupBy("sha", "body").agg(F.count(F.lit(1)).alias("group_size"), F.max_by("doc_id", "rank").alias("keep_id"),
                                          F.max_by("row", "rank").alias("keep_row")))
    groups = land(groups.select(F.col("sha").alias("of_sha"), "group_size", "keep_id", "keep_row"), "exact-groups")
    return marked.where(~F.col("suspect")), suspects, groups, n


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    unique, suspects, groups, n = _verified(docs)
    unique = unique.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                           F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    hot = F.col("group_size") > n / HOT_GROUPS
    hot_groups = groups.where(hot)                  # at most HOT_GROUPS rows
    narrow, same = suspects.select("doc_id", "row", "sha"), F.col("sha") == F.col("of_sha")
    in_hot = narrow.join(F.broadcast(hot_groups), same)
    others = narrow.join(F.broadcast(hot_groups.select("of_sha")), same, "left_anti").join(groups.where(~hot), same)
    return unique.unionByName(in_hot.unionByName(others).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts."""
    unique, suspects, groups, _ = _verified(docs, docs.columns)
    staying = suspects.join(groups.select("keep_row"), F.col("row") == F.col("keep_row"), "left_semi")
    return unique.select("carried.*").unionByName(staying.select("carried.*"))
