"""Operator 6: held-out accuracy, code-switched segments, and the recursions
against sums over all label sequences."""

import itertools
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from provisio.llm import crf_language as crf


def test_held_out_accuracy(documents, rows):
    got = {r.doc_id: r for r in crf.train_and_identify(documents).collect()}
    assert len(got) == len(rows)
    for row in rows:
        r = got[row["doc_id"]]
        assert r.held_out == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) and 0 <= r.score <= 1
    unseen = [row for row in rows if got[row["doc_id"]].held_out and row["lang"]]
    right = sum(got[row["doc_id"]].lang_pred == row["lang"] for row in unseen)
    assert len(unseen) > 20 and right >= 0.95 * len(unseen)


def test_predictions_do_not_read_labels(documents):
    model = crf.fit(crf.sample_texts(documents.where(~crf.held_out(F.col("doc_id")))))
    plain = {r.doc_id: (r.lang_pred, r.score) for r in crf.identify(documents, model).collect()}
    blind = documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert {r.doc_id: (r.lang_pred, r.score) for r in crf.identify(blind, model).collect()} == plain


def test_code_switched_text_is_segmented(documents, rows):
    model = crf.fit(crf.sample_texts(documents.where(~crf.held_out(F.col("doc_id")))))
    pick = {}
    for row in rows:
        if zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2 and row["n_chars"] > 600:
            pick.setdefault(row["lang"], row["text"].split()[:60])
    (a, left), (b, right) = sorted(pick.items())[:2]
    marginal = crf.Labeller(model).marginals([[w.lower() for w in left + right]])[0]
    label = [model.languages[i] for i in marginal.argmax(axis=1)]
    assert sum(x == a for x in label[:60]) >= 54 and sum(x == b for x in label[60:]) >= 54
    assert np.allclose(marginal.sum(axis=1), 1)


def test_forward_backward_equals_all_sequences():
    rng = np.random.default_rng(3)
    k, lengths = 3, np.array([5, 3, 1])
    emit, move, start = rng.normal(size=(5, 3, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    marginal, log_z, pairs = crf.forward_backward(emit, move, start, lengths)
    want_pairs = np.zeros((k, k))
    for c, n in enumerate(lengths):
        total, want = 0.0, np.zeros((n, k))
        chain_pairs = np.zeros((k, k))
        for labels in itertools.product(range(k), repeat=int(n)):
            score = start[labels[0]] + sum(emit[t, c, y] for t, y in enumerate(labels)) + sum(move[x, y] for x, y in zip(labels, labels[1:]))
            p = math.exp(score)
            total += p
            for t, y in enumerate(labels):
                want[t, y] += p
            for x, y in zip(labels, labels[1:]):
                chain_pairs[x, y] += p
        assert np.allclose(marginal[:n, c], want / total)
        assert log_z[c] == __import__("pytest").approx(math.log(total))
        want_pairs += chain_pairs / total
    assert np.allclose(pairs, want_pairs)


def test_edge_rows(edge, empty):
    got = crf.train_and_identify(edge).collect()
    assert len(got) == edge.count()
    undefined = {(r.doc_id, r.lang_pred) for r in got if r.lang_pred == "und"}
    assert {(3, "und"), (4, "und"), (5, "und"), (9, "und")} <= undefined
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert crf.train_and_identify(empty).count() == 0
    assert {r.lang_pred for r in crf.train_and_identify(edge.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = crf.identify(edge, None, keep=edge.columns, segments=True)
    assert kept.count() == edge.count() and "segments" in kept.columns


def test_small_caches_give_the_same_labels(documents, monkeypatch):
    model = crf.fit(crf.sample_texts(documents))
    words = [crf.words_of(r.text) for r in documents.limit(30).collect()]
    whole = crf.Labeller(model).marginals(words)
    monkeypatch.setattr(crf, "CACHE_WORDS", 50)
    monkeypatch.setattr(crf, "BLOCK_WORDS", 200)
    for a, b in zip(whole, crf.Labeller(model).marginals(words)):
        assert np.allclose(a, b)


def test_languages_of_only_long_or_only_short_texts_are_learned(spark):
    import random

    rng = random.Random(6)
    vocabulary = {"aa": ["alpha", "above", "after", "again"], "bb": ["bubble", "bobbin", "baby", "bib"], "cc": ["cocci", "cacao", "civic", "cynic"]}
    sizes = {"aa": 3000, "bb": 200, "cc": 4}            # words: all longer than the preferred texts, inside, all shorter
    rows = []
    for lang, words in vocabulary.items():
        for i in range(60):
            rows.append((len(rows), " ".join(rng.choice(words) + str(rng.randrange(9)) * (rng.random() < 0.2) for _ in range(sizes[lang])), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in crf.train_and_identify(docs).collect()}
    wrong = sum(got[i] != lang for i, _, lang in rows)
    assert wrong <= 3
    sample = crf.sample_texts(docs.select("lang", "text"))
    assert {lang for lang, _ in sample} == set(vocabulary) and max(len(t) for _, t in sample) <= crf.SAMPLE_CHARS[1]
