"""Operator 7: measures against plain counts, EM against planted accuracies."""

from collections import Counter

import numpy as np

from llm.conftest import WORD, table
from provisio.llm import weak_rules as wr


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def five(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)


def failed(m):
    return m[0] < 50 or 100 * m[4] > 50 * m[0]


def test_measures_and_verdicts(documents, rows):
    got = {r.doc_id: r for r in wr.quality(documents).collect()}
    assert len(got) == len(rows)
    for row in rows:
        r, m = got[row["doc_id"]], brute(row["text"])
        assert five(r) == m and r.base_failed == failed(m) and not (r.kept and r.base_failed)
    quality = {x["doc_id"]: x["quality"] for x in table("labels")}
    judged = [(got[i].kept, q) for i, q in quality.items() if not got[i].base_failed]
    right = sum(kept == bool(q) for kept, q in judged) / len(judged)
    assert right > 0.95
    assert all(kept for kept, q in judged if q)          # clean documents stay


def test_edge_rows(edge, empty):
    got = wr.quality(edge).collect()
    assert sorted(map(five, got)) == sorted(brute(r.text) for r in edge.collect())
    assert wr.measures(edge, keep=edge.columns).count() == edge.count()
    assert wr.quality(empty).count() == 0


def test_repeat_words_of_many_distinct_words():
    words = [f"w{i}" for i in range(3000)]
    text = words + words[100:103] + ["z"] + ["a"] * 5
    assert wr._repeat_words(text) == brute(" ".join(text))[4] == 6 + 5


def test_em_finds_planted_accuracies_and_a_useless_rule():
    rng = np.random.default_rng(0)
    n, right = 20_000, np.array([0.95, 0.9, 0.8, 0.85])
    good = rng.random(n) < 0.7
    votes = np.where(rng.random((n, 4)) < right, good[:, None], ~good[:, None]).astype(int) * 2 - 1
    votes[rng.random((n, 4)) < 0.3] = 0
    votes = np.column_stack((votes, np.ones(n, dtype=int)))       # says good to everything
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, g, b = wr.fit_votes(patterns, counts.astype(float))
    assert abs(prior - 0.7) < 0.02
    assert np.abs(g[:4] - right).max() < 0.03 and np.abs(b[:4] - right).max() < 0.03
    up = wr.vote_weights(prior, g, b)[1]
    assert abs(up[4]) < 0.02 < up[:4].min()
    p = wr.posterior(votes, prior, g, b)
    assert ((p >= 0.5) == good).mean() > 0.93
