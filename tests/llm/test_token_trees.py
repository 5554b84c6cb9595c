"""Operator 4: counts after edits against a full encoding by the library."""

import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from provisio.llm import bpe, token_trees as tt
from provisio.llm.queries import QUERIES
from llm.conftest import SMOKE

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
    ENCODER = bpe.encoder_of(f.read())


def count(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_random_edits_keep_exact_counts_and_sums():
    rng = random.Random(4)
    parts = ["word", "Ünï", "it's", " ", "  ", "\n", "\t", " ", "東京", "x" * 30, ".", "12", "\x1c", " a", "b "]
    for _ in range(40):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 400)))
        tree = tt.TokenTree(ENCODER, text)
        assert tree.tokens.total() == count(text)
        for _ in range(8):
            a = rng.randrange(len(text) + 1)
            b = min(len(text), a + rng.choice([0, 1, 3, 40, 600]))
            new = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 5, 300])))
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            assert tree.text == text and tree.chars.total() == len(text) and tree.tokens.total() == count(text)
            for t in (tree.chars, tree.tokens):
                assert all(t.nodes[k] == t.nodes[2 * k] + t.nodes[2 * k + 1] for k in range(1, t.size))


def test_an_edit_encodes_only_leaves_near_it():
    text = " ".join(f"word{i}" for i in range(20_000))
    tree = tt.TokenTree(ENCODER, text)
    at = len(text) // 2
    tree.edit(at, at + 5, "changed")
    assert 0 < tree.encoded_chars < 3 * tt.LEAF_PIECES * 10
    assert tree.tokens.total() == count(tree.text)


def test_query_counts_equal_full_encodings(spark, rows):
    got = {r.doc_id: r for r in QUERIES["op4_token_counts"](spark, SMOKE).collect()}
    assert len(got) == len(rows)
    for row in rows:
        t, r = row["text"], got[row["doc_id"]]
        mid, tenth = len(t) // 2, len(t) // 10
        low = max(mid - 8, 0)
        once = t[:low] + 2 * t[low:mid] + t[mid:]
        edited = once[:tenth] + f" {row['source']} " + once[tenth:]
        assert (r.n_tokens, r.edited_tokens) == (count(t), count(edited))


def test_edge_rows(spark, edge, empty):
    trees = tt.build_trees(edge)
    edits = spark.createDataFrame([(1, 5, 9, "NEW", 0), (1, 0, 0, "front ", 1), (6, 100, 200_000, None, 0), (4, 0, 5, "put in", 0), (3, 1, 2, "into null", 0)],
                                  "doc_id long, start long, stop long, replacement string, seq int")
    out = tt.apply_edits(tt.with_edits(trees, edits)).collect()
    assert len(out) == edge.count()
    for r in out:
        assert r.edited_tokens == count(r.text or "")
        if r.edits is None:
            assert r.encoded_chars == 0 and r.edited_tokens == r.n_tokens
    assert {r.text for r in out if r.doc_id == 4} == {"put in"} and {r.text for r in out if r.doc_id == 3} == {"into null"}
    none = tt.build_trees(empty).withColumn("edits", F.lit(None).cast(tt.EDITS))
    assert tt.apply_edits(none).count() == 0
