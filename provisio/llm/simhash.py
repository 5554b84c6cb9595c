"""SimHash near-duplicates by sharded BK-trees (operator 1).

A document's fingerprint has 64 bits: bit b is set if it is set in more than
half of its shingle hashes (XXH64, seed 42). Two fingerprints are linked when
they differ in at most ``radius`` bits; components are the transitive closure.

* Equal fingerprints collapse first (partial aggregation), so exact copies
  never meet as pairs.
* Of ``radius + agree`` bit blocks at least ``agree`` are equal in a linked
  pair. Each choice of ``agree`` blocks is a table, and its block values cut
  the fingerprints into shards. ``agree`` only sets the width of the shard
  key; every choice finds every link.
* A shard holds at most ``shard_rows`` fingerprints. Each builds one BK-tree
  (children keyed by their Hamming distance to the parent). A larger bucket is
  dealt over several shards and each shard's tree is sent the other shards'
  fingerprints as queries, so no tree grows without bound. Trees reach the
  tasks by the shuffle: a driver-side broadcast would pass all fingerprints
  through the driver.
* A search follows only edges within the radius. Below an edge of at most
  ``radius`` all nodes link to the parent already, so such a subtree is left
  at the first hit, and a whole cluster of near copies costs a few steps.
* Each shard returns a spanning forest of its links, and components are found
  by alternating large-star and small-star rounds over written tables.

Edge cases: a null, empty or blank text has no shingles and fingerprint zero
(linked like any other). Fewer words than the shingle length give one shingle
of all words. A very long text is hashed whole, as one row of one task. A bit
set in exactly half of the hashes is 0. Repeated rows and equal texts share a component. A null doc_id
never becomes a component id unless nothing else is there. An empty table
gives no rows. Helper columns never clash with extra columns.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import checkpoint_dir
from .common import fresh, land, map_batches, utf8
from .components import smallest_reachable

SHINGLE_WORDS = 4
RADIUS = 4
SHARD_ROWS = 8192
HASH_SEED = 42
BLOCK_SHINGLES = 1 << 16      # shingles whose bits are counted at a time
BROADCAST_KEYS = 20_000       # hot bucket keys: broadcast up to this count, joined by shuffle beyond


def text_fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of one text, as an unsigned integer."""
    from xxhash import xxh64_digest

    words = text.lower().split()          # bytes: only A-Z fold, only ASCII white space separates
    if not words:
        return 0
    n = len(words)
    if n <= shingle_words:
        return int.from_bytes(xxh64_digest(b" ".join(words), HASH_SEED), "big")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total, counts = n - shingle_words + 1, np.zeros(64, dtype=np.int64)
    lo, hi = starts[:total].tolist(), ends[shingle_words - 1:].tolist()
    for at in range(0, total, BLOCK_SHINGLES):
        digests = b"".join([xxh64_digest(joined[a:b], HASH_SEED)
                            for a, b in zip(lo[at:at + BLOCK_SHINGLES], hi[at:at + BLOCK_SHINGLES])])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, *, shingle_words: int = SHINGLE_WORDS, out: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """``doc_id`` (and other ``keep`` columns) with the signed 64-bit fingerprint."""
    ids = [(c, docs.schema[c].dataType) for c in (keep or ["doc_id"])]
    schema = ", ".join(f"`{c}` {t.simpleString()}" for c, t in ids) + f", `{out}` long"
    (body,) = fresh(docs.select(*[c for c, _ in ids]), "body")

    def run(batches):
        for b in batches:
            marks = np.array([text_fingerprint(t, shingle_words) for t in b.pop(body)], dtype=np.uint64)
            yield b | {out: marks.view(np.int64).tolist()}

    return map_batches(docs.select(*[c for c, _ in ids], utf8().alias(body)), run, schema)


class BkTree:
    """Fingerprints linked by integer distance; local components by union-find."""

    def __init__(self, radius: int) -> None:
        self.radius = radius
        self.points: list[int] = []
        self.children: list[dict[int, int] | None] = []
        self.parent: list[int] = []        # union-find over nodes (and outside queries)

    def _find(self, x: int) -> int:
        up = self.parent
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def insert(self, point: int) -> list[int]:
        """Add a point; return tree nodes it links to, one for each local component."""
        me = len(self.points)
        links = self.search(point) if me else []
        self.points.append(point)
        self.children.append(None)
        self.parent.append(me)
        if me:
            node = 0
            while True:
                d = (self.points[node] ^ point).bit_count()
                below = self.children[node]
                if below is None:
                    below = self.children[node] = {}
                if d not in below:
                    below[d] = me
                    break
                node = below[d]
        return self._join(me, links)

    def _join(self, me: int, links: list[int]) -> list[int]:
        new = []
        for x in links:
            a, b = self._find(x), self._find(me)
            if a != b:
                self.parent[b] = a
                new.append(x)
        return new

    def search(self, point: int) -> list[int]:
        """Nodes within the radius, at least one of every local component.

        All nodes under an edge <= radius link to the edge's upper node, so
        once that node or one below it is hit, the rest of them is known."""
        r, points, children = self.radius, self.points, self.children
        hits: list[int] = []
        stack: list[tuple[int, int]] = [(0, -1)]     # node, its ball (nodes known to be linked together) or -1
        done: set[int] = set()
        balls = 0
        while stack:
            node, ball = stack.pop()
            if ball in done:
                continue
            d = (points[node] ^ point).bit_count()
            if d <= r:
                hits.append(node)
                if ball >= 0:
                    done.add(ball)
                    continue
            below = children[node]
            if not below:
                continue
            inner = ball
            if inner < 0 and d > r:
                inner = balls
                balls += 1
            for edge, child in below.items():
                if d - r <= edge <= d + r:
                    if ball >= 0:
                        stack.append((child, ball))
                    elif edge > r:
                        stack.append((child, -1))
                    elif d > r:
                        stack.append((child, inner))
        return hits


def _tables(bits: int, radius: int, agree: int) -> list[int]:
    """Bit masks: every pair within ``radius`` agrees on all bits of one of them."""
    blocks = radius + agree
    edges = [bits * i // blocks for i in range(blocks + 1)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    out = []
    for chosen in combinations(masks, agree):
        mask = 0
        for m in chosen:
            mask |= m
        out.append(mask)
    return out


def _agree_for(rows: int, radius: int) -> int:
    """Blocks to agree on: the fewest that leave about 64 fingerprints a bucket."""
    agree = 1
    while agree < 4 and rows / 2 ** (64 * agree / (radius + agree)) > 64 and comb(radius + agree, agree) < 70:
        agree += 1
    return agree


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(marks: DataFrame, *, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, rows: int | None = None,
          agree: int | None = None) -> DataFrame:
    """(src, dst) node links between distinct fingerprints: a spanning forest
    of every shard. ``marks`` has ``fp`` (distinct) and ``node``."""
    n = marks.count() if rows is None else rows
    masks = _tables(64, radius, agree or _agree_for(n, radius))
    keyed = marks.select("node", "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("tab", "key"))
    hot = (keyed.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows)
           .select("tab", "key", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards")))
    hot = land(hot, "hot-buckets")
    few = hot.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    dealt = keyed.join(F.broadcast(hot) if few else hot, ["tab", "key"], "left").withColumn(
        "own", F.coalesce(F.pmod(F.xxhash64("fp", F.lit(7)), F.col("shards")), F.lit(0)).cast("int"))
    # a point builds its own shard's tree (role 0) and asks the shards after it (role 1)
    sent = dealt.select("node", "fp", "tab", "key", "own", F.explode(F.sequence(
        F.col("own"), F.coalesce(F.col("shards"), F.lit(1)) - 1)).alias("shard")) \
        .withColumn("role", (F.col("shard") != F.col("own")).cast("int"))
    grouped = sent.repartition("tab", "key", "shard").sortWithinPartitions("tab", "key", "shard", "role")

    def search(batches):
        state, tree, nodes = None, None, []
        for b in batches:
            src, dst = [], []
            for node, fp, tab, key, shard, role in zip(b["node"], b["fp"], b["tab"], b["key"], b["shard"], b["role"]):
                point = fp & 0xFFFFFFFFFFFFFFFF
                if (tab, key, shard) != state:
                    state, tree, nodes = (tab, key, shard), BkTree(radius), []
                if role == 0:
                    found = tree.insert(point)
                    nodes.append(node)
                else:
                    found = tree.search(point) if tree.points else []
                    roots = {}
                    for x in found:
                        roots.setdefault(tree._find(x), x)
                    found = list(roots.values())
                src.extend([node] * len(found))
                dst.extend([nodes[x] for x in found])
            yield {"src": src, "dst": dst}

    return map_batches(grouped.select("node", "fp", "tab", "key", "shard", "role"), search, "src long, dst long", max_bytes=4 << 20)


def near_duplicates(docs: DataFrame, *, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of
    the component, its own included)."""
    checkpoint_dir(docs.sparkSession)
    marked = land(fingerprints(docs.select("doc_id", "text"), shingle_words=shingle_words), "fingerprints")
    labels = component_labels(marked, radius=radius, shard_rows=shard_rows)
    return (marked.join(labels, "fp", "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def component_labels(marked: DataFrame, *, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(fp, root, component_id) for the fingerprints of ``marked`` (doc_id, fp);
    root is the component's smallest fingerprint."""
    distinct = land(marked.groupBy("fp").agg(F.min("doc_id").cast("long").alias("smallest")), "distinct-fp")
    # the fingerprint itself is the node; labels are smallest doc_ids
    found = land(links(distinct.select(F.col("fp").alias("node"), "fp"), radius=radius, shard_rows=shard_rows)
                 .distinct(), "links")
    return smallest_reachable(distinct.select(F.col("fp").alias("node"), F.col("smallest").alias("label")), found) \
        .select(F.col("node").alias("fp"), "root", F.col("label").alias("component_id"))


def representatives(docs: DataFrame, *, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS,
                    shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of ``docs`` for each component: the smallest doc_id (null ids
    last), and of rows sharing it the smallest text hash."""
    checkpoint_dir(docs.sparkSession)
    tie, best_id, best_tie = fresh(docs, "text_hash", "best_id", "best_tie")
    hashed = docs.withColumn(tie, F.xxhash64("text"))
    marked = land(fingerprints(hashed.select("doc_id", tie, "text"), shingle_words=shingle_words, keep=["doc_id", tie]), "fingerprints")
    labels = component_labels(marked, radius=radius, shard_rows=shard_rows).select("fp", "root")
    best = marked.join(labels, "fp").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", tie)).alias("best")) \
        .select(F.col("best.doc_id").alias(best_id), F.col(f"best.{tie}").alias(best_tie))
    kept = hashed.join(best, F.col("doc_id").eqNullSafe(F.col(best_id)) & (F.col(tie) == F.col(best_tie)), "left_semi")
    if marked.groupBy("doc_id", tie).count().where("count > 1").limit(1).count():    # repeated rows are there
        kept = kept.dropDuplicates(["doc_id", tie])
    return kept.select(*docs.columns)
