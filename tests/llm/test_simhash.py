"""Operator 1 against all pairs."""

import random

import pytest
import xxhash

from llm.conftest import WORD, lower_ascii
from provisio.llm import simhash


def brute_fingerprint(text, k=4):
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks, radius=4):
    """marks: fingerprints; the index set of every component."""
    group = list(range(len(marks)))
    for i in range(len(marks)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= radius and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def expected(rows):
    marks = [brute_fingerprint(t) for _, t in rows]
    group = brute_components(marks)
    least = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return sorted(((d, format(m, "016x"), least.get(g)) for (d, _), m, g in zip(rows, marks, group)), key=repr)


@pytest.mark.parametrize("shard_rows", [8192, 3])
def test_near_duplicates_equal_all_pairs(documents, rows, shard_rows):
    got = simhash.near_duplicates(documents, shard_rows=shard_rows).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == expected([(r["doc_id"], r["text"]) for r in rows])


def test_edge_rows(edge, empty):
    got = simhash.near_duplicates(edge).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == \
        expected([(r.doc_id, r.text) for r in edge.collect()])
    assert simhash.near_duplicates(empty).columns == ["doc_id", "fingerprint", "component_id"]
    assert simhash.near_duplicates(empty).count() == 0


def test_representatives_keep_one_row_of_each_component(edge, empty):
    kept = simhash.representatives(edge)
    assert kept.columns == edge.columns
    got = kept.collect()
    # equal to the components: the prose, the tie, no words (null, empty, blank), the others
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [
        (False, 1), (False, 2), (False, 3), (False, 6), (False, 7), (False, 8), (False, 9), (True, 0)]
    assert simhash.representatives(empty).count() == 0


def test_bk_tree_finds_every_component_of_dense_clusters():
    rng = random.Random(5)
    points = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(60):
            points.append(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 7))))
    points = list(dict.fromkeys(points))
    tree, group = simhash.BkTree(4), list(range(len(points)))
    for p in points:
        tree.insert(p)
    local = [tree._find(i) for i in range(len(points))]
    want = brute_components(points)
    assert len(set(zip(local, want))) == len(set(local)) == len(set(want))
    for p in (rng.choice(points) ^ 5 for _ in range(200)):
        near = {want[i] for i, x in enumerate(points) if (x ^ p).bit_count() <= 4}
        assert {want[i] for i in tree.search(p)} == near
    assert group


@pytest.mark.parametrize("agree", [1, 2, 3, 4])
def test_tables_cover_every_pair_within_the_radius(agree):
    rng = random.Random(agree)
    masks = simhash._tables(64, 4, agree)
    for _ in range(2000):
        flips = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not flips & m for m in masks)


@pytest.mark.parametrize("agree", [2, 3])
def test_wider_keys_give_the_same_components(spark, documents, agree):
    marked = simhash.fingerprints(documents.select("doc_id", "text"))
    distinct = [r.fp & (1 << 64) - 1 for r in marked.select("fp").distinct().collect()]
    got = simhash.links(spark.createDataFrame([(i, m - (1 << 64) if m >> 63 else m) for i, m in enumerate(distinct)], "node long, fp long"), agree=agree).collect()
    group = list(range(len(distinct)))
    for r in got:
        assert (distinct[r.src] ^ distinct[r.dst]).bit_count() <= 4
        a, b = group[r.src], group[r.dst]
        group = [b if g == a else g for g in group]
    want = brute_components(distinct)
    assert len(set(zip(group, want))) == len(set(group)) == len(set(want))
