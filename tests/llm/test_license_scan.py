"""Operator 2 against a plain phrase search and a plain substring search."""

import random
import re

from llm.conftest import lower_ascii
from provisio.llm import license_scan as ls

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_base(text):
    words = WORDS.findall(lower_ascii(text or ""))
    starts, labels = [], set()
    for phrase, label in ls.BASE_PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        starts += here
        labels |= {label} if here else set()
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def base_of(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)


def test_base_columns(documents, rows):
    got = {r.doc_id: r for r in ls.scan_licenses(documents).collect()}
    assert len(got) == len(rows)
    for row in rows:
        r = got[row["doc_id"]]
        assert base_of(r) == brute_base(row["text"])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.base_labels)


def test_edge_rows(edge, empty):
    source = edge.collect()
    got = ls.scan_licenses(edge, keep=edge.columns).collect()
    assert sorted(map(base_of, got), key=repr) == sorted((brute_base(r.text) for r in source), key=repr)
    assert all(r.labels == "" and r.spans == [] for r in got)
    assert ls.scan_licenses(empty).count() == 0


def test_suffix_automaton_runs_are_the_longest_ones():
    rng = random.Random(1)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        automaton = ls.SuffixAutomaton(sequences)
        text = [rng.randrange(4) for _ in range(30)]
        inside = lambda run: any(s[i:i + len(run)] == run for s in sequences for i in range(len(s)))
        longest = [max((n for n in range(i + 1) if n == 0 or inside(text[i + 1 - n:i + 1])), default=0) for i in range(len(text))]
        longest = [n if n or not inside([t]) else 1 for n, t in zip(longest, text)]
        longest = [max(n, i + 1 if inside(text[:i + 1]) else 0) for i, n in enumerate(longest)]
        want = {(i + 1, n) for i, n in enumerate(longest) if n and (i + 1 == len(text) or longest[i + 1] <= n)}
        found = automaton.runs(text, 1)
        assert {(end, n) for end, n, _ in found} == want
        for end, n, state in found:
            run = text[end - n:end]
            assert automaton.places[state] == {(t, i + n) for t, s in enumerate(sequences) for i in range(len(s) - n + 1) if s[i:i + n] == run}


def test_edited_template_is_one_span_with_its_place():
    scan = ls._scanner(tuple(ls.TEMPLATES.items()), tuple(ls.BASE_PHRASES.items())).scan
    body = ls.TEMPLATES["mit"][2]
    edited = body.replace("free of charge", "free of any charge").replace("sublicense", "relicense")
    r = scan(("many words before it here. " * 3 + edited + " and words after").encode())
    assert r["labels"] == "mit" and r["n_base"] == 0 and 0.9 < r["score"] < 1
    assert r["spans"][0]["start"] == 15 and r["spans"][0]["end"] == 15 + len(ls.words_of(edited.encode()))
    assert scan(b"the rights of the software are to be used and to be copied by any person")["labels"] == ""
    twice = scan((body + " something else entirely between the copies of this text and more. " + body).encode())
    assert [s["label"] for s in twice["spans"]] == ["mit", "mit"]


def edited(words, rng, share):
    """Each word is replaced, dropped or followed by another at the given rate."""
    out = []
    for w in words:
        draw = rng.random()
        if draw < share / 3:
            continue
        out += [f"other{rng.randrange(99)}"] if draw < share * 2 / 3 else [w, f"added{rng.randrange(99)}"] if draw < share else [w]
    return out


def test_recall_on_edited_bodies_and_none_on_shuffled_ones():
    rng = random.Random(7)
    scan = ls._scanner(tuple(ls.ALL_TEMPLATES.items()), ()).scan
    for label, bodies in ls.BODIES.items():
        for body in bodies:
            words = body.split()
            assert scan(body.encode())["labels"].split(",") == [label], label
            for share, least in ((0.04, 1.0), (0.1, 0.9)):
                found = 0
                for _ in range(30):
                    text = " ".join(["before"] * 20 + edited(words, rng, share) + ["behind"] * 20)
                    found += label in scan(text.encode())["labels"].split(",")
                assert found >= least * 30, (label, share, found)
            shuffled = rng.sample(words, len(words))
            assert scan(" ".join(shuffled).encode())["labels"] == ""


def test_a_shared_passage_marks_no_licence():
    scan = ls._scanner(tuple(ls.ALL_TEMPLATES.items()), ()).scan
    body = ls.BODIES["mit"][0]
    shared = body[body.index("THE SOFTWARE IS PROVIDED"):]
    r = scan(shared.encode())
    assert r["labels"] == "" and 0.3 < r["score"] < ls.MIN_COVERED


def test_very_long_texts_and_ties(spark):
    body = ls.BODIES["isc"][0]
    long = "plain words of a long text " * 40_000 + body + " more of it" * 10_000
    docs = spark.createDataFrame([(1, long), (2, body), (2, body)], "doc_id long, text string")
    got = sorted(ls.scan_licenses(docs).collect(), key=lambda r: r.doc_id)
    assert [r.labels for r in got] == ["isc"] * 3 and got[1] == got[2] and got[0].spans[0].start == 240_000
