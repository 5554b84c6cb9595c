"""Operator 11 against plain regular expressions over code points."""

import hashlib
import random
import re
import time
from collections import Counter

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from provisio.llm import fim
from provisio.llm.queries import QUERIES
from llm.conftest import SMOKE

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    lo, hi = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    form = "spm" if h4 % 100 < 80 else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def outputs(docs):
    done = fim.fill_in_middle(docs).withColumn("back", fim.restore(F.col("output"), F.col("form")))
    return [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in done.collect()]


def test_whole_table(documents, rows):
    want = Counter((r["doc_id"], *brute(r["doc_id"], r["text"]), r["text"] or "") for r in rows)
    got = outputs(documents)
    assert Counter(got) == want
    assert {"plain", "psm", "spm"} == {r[2] for r in got}


def test_query_digests(spark, rows):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((r["doc_id"], *b[:4], sha(b[4]), sha(r["text"] or "")) for r in rows for b in [brute(r["doc_id"], r["text"])])
    got = QUERIES["op11_fim"](spark, SMOKE)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert Counter(map(tuple, got.collect())) == want


def test_edge_rows_and_marks(spark, edge, empty):
    extra = [(i, t) for i in range(40) for t in (f"a <P> in text {i}", f"ends in <{i}<", "<", f"< P><S {i} M>", " \n", f"ä <M{i} ", "")]
    docs = edge.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    want = Counter((r.doc_id, *brute(r.doc_id, r.text), r.text or "") for r in docs.collect())
    assert Counter(outputs(docs)) == want
    kept = fim.fill_in_middle(edge, keep=edge.columns)
    assert set(edge.columns) | {"n", "form", "output"} <= set(kept.columns) and len(kept.columns) == len(set(kept.columns))
    assert kept.where("tie <> 'extra tie'").count() == 0
    assert outputs(empty) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "word", " ", "  ", "\n", "\t", "é", "東京", "🙂", "x" * 70, " y" * 90, " ", "\x0b"]), max_size=60))
def test_every_cut_of_a_text(parts):
    text = "".join(parts)
    ends = [0]
    for u in UNIT.findall(text):
        ends.append(ends[-1] + len(u))
    found = fim.Located(text.encode(), fim.ChunkCache())
    assert found.n == len(ends) - 1
    for k, end in enumerate(ends):
        assert found.end_of(k) == (len(text[:end].encode()), end)


def test_chunks_cover_the_text_and_follow_content():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(900)]
    passage = " ".join(rng.choice(words) for _ in range(3000)).encode()
    texts = [" ".join(rng.choice(words) for _ in range(50 * i)).encode() + b" " + passage for i in range(1, 5)]
    seen = []
    for t in texts:
        ends = fim.chunks(t)
        assert ends[-1] == len(t) and all(0 < b - a <= fim.MAX_CHUNK for a, b in zip([0, *ends], ends))
        seen.append({t[a:b] for a, b in zip([0, *ends], ends)})
    assert len(set.intersection(*seen)) > 0.8 * len(fim.chunks(passage))


def test_cache_stays_bounded_and_is_reused():
    cache = fim.ChunkCache(most_bytes=20_000)
    rng = random.Random(1)
    for i in range(200):
        text = " ".join(str(rng.randrange(10**6)) for _ in range(300)).encode()
        fim.Located(text, cache)
        assert cache.held <= 20_000 + fim.MAX_CHUNK + fim.CACHE_ENTRY
    before = cache.hits
    fim.Located(text, cache)
    assert cache.hits > before


def test_long_word_and_long_text():
    for text in (b"x" * 3_000_000, b"word " * 600_000, b" " * 2_000_000 + b"end"):
        start = time.time()
        found = fim.Located(text, fim.ChunkCache())
        assert found.end_of(found.n)[0] == len(text)
        found.end_of(found.n // 2)
        assert time.time() - start < 5
