"""Merkle-tree fingerprints of documents (operator 8).

A text is a tree: document, sections, paragraphs, sentences. Paragraphs are
lines. A section ends at a blank line or after a paragraph whose hash is a
multiple of ``SECTION_EVERY`` (cut by content, so an inserted line moves no
other section). Sentences end after ``.``, ``!`` or ``?`` and a space; one of
more than ``LEAF_BYTES`` bytes (a line without full stops, a script without
spaces) is cut into several leaves where a rolling hash of its bytes says so, so
an edit changes the leaves around it only. Each node hashes its children, so equal roots mean equal texts. The fingerprint
string holds the root, then every section's paragraphs' sentence hashes.

Two fingerprints are compared from the root down: equal branches count whole
and are left out, only differing ones are opened. ``likeness`` is the share
of sentences (leaves) in equal branches; ``edited_leaves`` locates the edit.

``fingerprint_edits`` needs each document's successor in doc_id order: ids are
cut into blocks at quantiles, each block is sorted in a task of its own, and
its first document is also sent to the block before. Null ids, and an id of
many rows, are cut further by the text's hash, and copies under one id by the
row's place (then the rows are written first). The texts are shuffled once.

Edge cases: a null text is empty and has a fingerprint like any other; a very
long one is fingerprinted whole. Rows that share a doc_id are ordered by a text
hash (copies in any order, which changes no result); null ids come first. The last
document's successor is the first one (itself, if it is alone). An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F

from .common import land, map_batches, shuffle_partitions, utf8
from .fim import cut_candidates

SECTION_EVERY = 4
ROOT_BYTES, LEAF_HEX = 16, 8
MAX_BLOCKS = 20_000      # cuts are literals of the plan; a block is only streamed, so its size is free
LEAF_BYTES = 192         # a longer sentence is cut by content, into leaves of at least LEAF_LEAST bytes
LEAF_LEAST = 48
_LEAF_BITS = 6           # behind one byte in 2^6
_SENTENCE = re.compile(r"(?<=[.!?]) ")


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=ROOT_BYTES).digest()


def leaves_of(line: str) -> list[bytes]:
    """The leaf hashes of a line: its sentences, long ones cut by content."""
    out = []
    for sentence in _SENTENCE.split(line):
        data = sentence.encode("utf-8", "surrogatepass")
        last = 0
        if len(data) > LEAF_BYTES:
            for end in cut_candidates(data, _LEAF_BITS).tolist():
                if end - last >= LEAF_LEAST and end < len(data):
                    out.append(_digest(data[last:end]))
                    last = end
        out.append(_digest(data[last:]))
    return out


def tree(text: str) -> tuple[bytes, list[list[list[bytes]]]]:
    """(root, sections of paragraphs of sentence hashes)."""
    sections: list[list[list[bytes]]] = [[]]
    nodes: list[list[bytes]] = [[]]
    for line in text.split("\n"):
        leaves = leaves_of(line)
        paragraph = _digest(b"p" + b"".join(leaves))
        sections[-1].append(leaves)
        nodes[-1].append(paragraph)
        if not line.strip() or paragraph[0] % SECTION_EVERY == 0:
            sections.append([])
            nodes.append([])
    if not sections[-1]:
        sections.pop()
        nodes.pop()
    return _digest(b"d" + b"".join(_digest(b"s" + b"".join(n)) for n in nodes)), sections


def fingerprint(text: str) -> str:
    """Root in hex, ``:``, sections split by ``/``, paragraphs by ``,``,
    sentences as ``LEAF_HEX`` digits each."""
    root, sections = tree(text)
    short = LEAF_HEX // 2
    return root.hex() + ":" + "/".join(",".join(b"".join([x[:short] for x in p]).hex() for p in s) for s in sections)


def _leaves(paragraph: str) -> list[str]:
    return [paragraph[i:i + LEAF_HEX] for i in range(0, len(paragraph), LEAF_HEX)]


def likeness(a: str, b: str) -> float:
    """Shared leaves over all leaves (Dice), 1.0 for equal roots."""
    root_a, _, body_a = a.partition(":")
    root_b, _, body_b = b.partition(":")
    if root_a == root_b:
        return 1.0
    digits = lambda body: sum(map(len, body.replace("/", ",").split(","))) // LEAF_HEX
    total = digits(body_a) + digits(body_b)
    shared, left, right = 0, [body_a], [body_b]
    for open_branch in (lambda s: s.split("/"), lambda s: s.split(","), _leaves):
        at, bt = (Counter(x for s in side for x in open_branch(s)) for side in (left, right))
        same = at & bt
        shared += sum(n * digits(x) for x, n in same.items())
        left, right = list((at - same).elements()), list((bt - same).elements())
        if not left or not right:
            break
    return 2.0 * shared / total if total else 0.0


def edited_leaves(a: str, b: str) -> tuple[int, int, int]:
    """(first, end in a, end in b): the leaves that differ, between the equal
    leading and trailing ones."""
    x, y = ([leaf for p in f.partition(":")[2].replace("/", ",").split(",") for leaf in _leaves(p)] for f in (a, b))
    first = 0
    while first < min(len(x), len(y)) and x[first] == y[first]:
        first += 1
    tail = 0
    while tail < min(len(x), len(y)) - first and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    return first, len(x) - tail, len(y) - tail


def _block_of(column: Column, cuts: list[int]) -> Column:
    """How many cuts are <= the value: a two-step search over literal arrays."""
    if not cuts:
        return F.lit(0)
    step = max(1, isqrt(len(cuts)))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    count = lambda arr: F.size(F.filter(arr, lambda c: c <= column))
    group = count(longs([g[0] for g in groups]))
    return F.when(group == 0, 0).otherwise(
        (group - 1) * step + count(F.element_at(F.array(*[longs(g) for g in groups]), group)))


LOWEST = -(1 << 63)


def _hot_cuts(slim: DataFrame, hot: dict[int | None, int], n_rows: int, n: int) -> tuple[dict, list]:
    """Cuts (tie, salt) inside each hot id, and the (id, tie) whose copies need
    the salt: text hashes are spread evenly, but for copies of one text."""
    hot_id = F.col("doc_id").isin([h for h in hot if h is not None])
    if None in hot:
        hot_id = hot_id | F.col("doc_id").isNull()
    # at most n groups hold more than an n-th of the rows
    copies = slim.where(F.coalesce(hot_id, F.lit(False))).groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") * n > n_rows).collect()
    cuts = {h: {(LOWEST + i * (1 << 64) // m, LOWEST) for i in range(1, m)} for h, m in hot.items()}
    for r in copies:
        m = -(-r["n"] * n // n_rows)
        cuts[r["doc_id"]] |= {(r["tie"], LOWEST + i * (1 << 64) // m) for i in range(m)}
    return {h: sorted(c) for h, c in cuts.items()}, copies


def _dealt(slim: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(doc_id, body, tie, salt, block, role) and the number of blocks. Blocks
    follow (doc_id, tie, salt); role 0 is a block's own row, 1 the next block's
    first row, 2 the first of all behind the last."""
    # quantiles are values of the column; one row of at most `n` numbers
    n_rows, n_ids, smallest, marks = slim.agg(
        F.count(F.lit(1)), F.count("doc_id"), F.min("doc_id"),
        F.percentile_approx("doc_id", F.array(*[F.lit(i / n) for i in range(n)]), 10 * n)).first()
    times = Counter(marks or [])
    hot: dict[int | None, int] = {c: k for c, k in times.items() if k > 1}
    if (n_rows - n_ids) * n > n_rows:
        hot[None] = -(-(n_rows - n_ids) * n // n_rows)
    cuts = {c for c in times if c > smallest or None in hot} | {h + 1 for h in hot if h is not None and h < (1 << 63) - 1}
    cuts = sorted(cuts)
    block, salt, last = F.when(F.col("doc_id").isNull(), 0).otherwise(_block_of(F.col("doc_id"), cuts)), F.lit(0).cast("long"), len(cuts)
    if hot:
        within, copies = _hot_cuts(slim, hot, n_rows, n)
        if copies:           # the salt is a row's place, so the rows are written before it is used
            slim = land(slim.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "hot-ids")
            salt = F.col("salt")
        behind, inside = F.lit(0), F.lit(0)
        for h, pairs in within.items():
            literal = F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(x).cast("long").alias("x")) for t, x in pairs])
            passed = F.size(F.filter(literal, lambda c: (c["t"] < F.col("tie")) | ((c["t"] == F.col("tie")) & (c["x"] <= salt))))  # noqa: B023
            later = F.col("doc_id").isNotNull() if h is None else F.col("doc_id") > h
            behind = behind + F.when(later, len(pairs)).otherwise(0)
            inside = F.when(F.col("doc_id").eqNullSafe(F.lit(h).cast("long")), passed).otherwise(inside)
            last += len(pairs)
        block = block + behind + inside
    tagged = slim.select("doc_id", "body", "tie", salt.alias("salt"), block.cast("int").alias("block"))
    key = F.struct("doc_id", "tie", "salt")
    # one row a block
    starts = sorted(tuple(r) for r in tagged.groupBy("block").agg(F.min(key).alias("start")).collect())
    guests = [(block, start, starts[i - 1][0], 1 if i else 2) for i, (block, start) in enumerate(starts)]
    firsts = slim.sparkSession.createDataFrame(
        guests, "block int, start struct<doc_id: long, tie: long, salt: long>, goes int, guest int")
    homes = F.filter(F.array(
        F.struct(F.col("block"), F.lit(0).alias("role")),
        F.when(F.col("start") == key, F.struct(F.col("goes").alias("block"), F.col("guest").alias("role")))), lambda h: h.isNotNull())
    return (tagged.join(F.broadcast(firsts), "block").select("doc_id", "body", "tie", "salt", F.explode(homes).alias("home"))
            .select("doc_id", "body", "tie", "salt", "home.block", "home.role")), last + 1


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, edit_from int, edit_to int")


def fingerprint_edits(docs: DataFrame, *, blocks: int | None = None) -> DataFrame:
    """Every document's fingerprint beside that of its edited text: the last
    half of its code points replaced by the first as many of its successor."""
    spark = docs.sparkSession
    n = blocks or min(shuffle_partitions(spark), MAX_BLOCKS)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("body"))
    sent, last = _dealt(slim.withColumn("tie", F.xxhash64("body")), n)
    ordered = sent.repartitionById(last, F.col("block")) \
        .sortWithinPartitions("block", "role", F.col("doc_id").asc_nulls_first(), "tie", "salt")

    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches):
        held = None          # the row whose successor comes next: (block, doc_id, text, fingerprint)
        for b in batches:
            out = {c: [] for c in names}
            for doc_id, body, block, role in zip(b["doc_id"], b["body"], b["block"], b["role"]):
                if role and (held is None or held[0] != block):
                    continue             # further documents at a cut; one is enough
                text = body.decode("utf-8", "replace")
                mark = fingerprint(text)
                if held is not None and held[0] == block:
                    _, own_id, own, own_mark = held
                    half = len(own) // 2
                    edited = own[:len(own) - half] + text[:half]
                    edited_mark = fingerprint(edited)
                    lo, hi, _ = edited_leaves(own_mark, edited_mark)
                    for c, v in zip(names, (own_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_mark, edited_mark,
                                            likeness(own_mark, edited_mark), likeness(own_mark, mark), lo, hi)):
                        out[c].append(v)
                held = None if role else (block, doc_id, text, mark)
            yield out

    return map_batches(ordered.select("doc_id", "body", "block", "role"), run, RESULT)
