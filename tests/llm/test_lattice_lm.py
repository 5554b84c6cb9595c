"""Operator 5: base scores against plain counts, lattices against all segmentations."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from llm.conftest import WORD, lower_ascii
from provisio.llm import lattice_lm as lm

with open(lm.default_pieces_path(), "rb") as f:
    PIECES = lm.Pieces.from_file(f.read())


def tokens(text):
    return WORD.findall(lower_ascii(text or "")) + ["\n"]          # the end: no word holds a line break


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute(rows):
    counts = Counter(t for d, text in rows if not is_held_out(d) for t in tokens(text))
    unit = sum(counts.values()) + len(counts) + 1
    return sorted((repr(d), is_held_out(d), len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), sum(counts.values()),
                   sum(math.log10((counts[x] + 1) / unit) for x in tokens(t))) for d, t in rows)


def compare(docs, **options):
    got = lm.score_texts(docs, **options).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    mine = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    assert len(mine) == len(want)
    for a, b in zip(mine, want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    return got


@pytest.mark.parametrize("frequent", [200_000, 500, 0])
def test_base_scores_and_same_model_for_any_broadcast(documents, frequent):
    got = compare(documents, frequent_words=frequent)
    if not hasattr(test_base_scores_and_same_model_for_any_broadcast, "seen"):
        test_base_scores_and_same_model_for_any_broadcast.seen = {r.doc_id: r.score for r in got}
    for r in got:
        assert r.score == pytest.approx(test_base_scores_and_same_model_for_any_broadcast.seen[r.doc_id], rel=1e-9)


def test_edge_rows(edge, empty):
    compare(edge)
    assert lm.score_texts(empty).count() == 0


def all_segmentations(pieces, text):
    """Sum over segmentations by plain recursion, characters spelled if need be."""
    texts = {t: i for t, i in pieces.single.items()}
    by_text = dict(texts)
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=lm.default_pieces_path())
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            by_text[sp.id_to_piece(i)] = i
    memo = {len(text): 1.0}

    def rest(i):
        if i not in memo:
            total = 0.0
            for j in range(i + 1, len(text) + 1):
                part = text[i:j]
                if part in by_text:
                    total += math.exp(pieces.log_p[by_text[part]]) * rest(j)
                elif j == i + 1:
                    total += math.exp(sum(pieces.log_p[b] for b in pieces.byte_ids[list(part.encode())])) * rest(j)
            memo[i] = total
        return memo[i]

    return math.log(rest(0))


def test_lattice_sums_all_segmentations():
    words = ["the", "nation", "internationalisation", "a", "zzzz", "東京", "naïve", "🙂x", "hello-world,", "ß" * 12]
    got = PIECES.scores([w.encode() for w in words])
    for w, s in zip(words, got):
        assert s == pytest.approx(all_segmentations(PIECES, "▁" + w), rel=1e-9)


def test_piece_probabilities_sum_to_one_and_em_raises_the_likelihood():
    counts = Counter("the cat sat on the mat and the other cat sang nation station ration".split())
    words, n = [w.encode() for w in counts], np.array(list(counts.values()), dtype=float)
    model, last = PIECES, -np.inf
    for _ in range(4):
        assert np.exp(model.log_p[np.isfinite(model.log_p)]).sum() + math.exp(model.log_end) == pytest.approx(1.0)
        expected = np.zeros(len(model.log_p))
        total = (model.scores(words, n, expected) * n).sum()
        assert total > last
        last = total
        # every arc's posterior covers the characters of its word once (bytes cover none here)
        with np.errstate(divide="ignore"):
            model = model.with_scores(np.log(expected / expected.sum() * 0.9), math.log(0.1))


def test_long_words_do_not_underflow():
    word = ("qxzj" * 5000).encode()
    assert np.isfinite(PIECES.scores([word, b"a"])).all()


@pytest.mark.parametrize("block", [7, 50, 1 << 16])
def test_walked_words_equal_the_vectorised_lattice(monkeypatch, block):
    monkeypatch.setattr(lm, "WALK_BLOCK", block)
    for word in ("a", "hello-world," * 5, "東京naïve🙂" * 9, "qxzj" * 60, "internationalisation" * 20):
        text, by_lattice, by_walk = "▁" + word, np.zeros(len(PIECES.log_p)), np.zeros(len(PIECES.log_p))
        want = PIECES._lattice([text], len(text), np.array([3.0]), by_lattice)[0]
        assert PIECES._walk(text, 3.0, by_walk) == pytest.approx(want, rel=1e-12)
        assert PIECES._walk(text, None, None) == pytest.approx(want, rel=1e-12)
        assert by_walk == pytest.approx(by_lattice, abs=1e-9)


def test_a_text_of_one_long_word(spark):
    long = "QxZj09+/aB" * 30_000
    docs = spark.createDataFrame([(1, long), (2, "a short text"), (3, long + " " + "the" * 20_000)], "doc_id long, text string")
    started = time.perf_counter()
    got = {r.doc_id: r.score for r in compare(docs)}
    assert got[1] < 1000 * got[2] and got[3] < got[1] and time.perf_counter() - started < 60


def test_rounds_end_near_the_best_likelihood(documents):
    """Against 12 plain rounds over all words in one process."""
    rows = [r.text for r in documents.select("text").collect()]
    counts = Counter(w.encode() for t in rows for w in lower_ascii(t or "").split())
    words, n = list(counts), np.array(list(counts.values()), dtype=float)
    best, own = PIECES, np.exp(PIECES.log_p)
    for _ in range(12):
        expected = np.zeros(len(own))
        best.scores(words, n, expected)
        best, _ = lm._maximise(best, expected, len(rows), own)
    spark_counts = lm.count_words(documents.select("text"))
    with open(lm.default_pieces_path(), "rb") as f:
        fitted = lm.fit_pieces(spark_counts, len(rows), f.read())
    assert fitted.scores(words) @ n == pytest.approx(best.scores(words) @ n, rel=2e-3)
