"""Operators 4 and 9 on texts with the tokenizer file's added token, against the
``tokenizers`` library with add_special_tokens=False and nothing else set."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from provisio.llm import bpe, pack, token_trees as tt

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
MARK = "<|endoftext|>"
with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
    ENCODER = bpe.encoder_of(f.read())


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([MARK, "a", "word", " ", "\n", "  ", "\t", "'s", "é東", "<|", "|>", "endoftext", ".", "1", " x"]), max_size=14))
def test_ids_of_texts_with_the_marker(parts):
    text = "".join(parts)
    assert np.frombuffer(ENCODER.encode(text.encode()), dtype="<u4").tolist() == ids_of(text)


def test_edits_that_make_and_split_markers():
    rng = random.Random(5)
    parts = [MARK, " " + MARK, MARK + " ", "word", " word", " ", "  ", "\n", "<|endof", "text|>", ".", "é"]
    for _ in range(40):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 400)))
        tree = tt.TokenTree(ENCODER, text)
        assert tree.tokens.total() == len(ids_of(text))
        for _ in range(8):
            a = rng.randrange(len(text) + 1)
            b = min(len(text), a + rng.choice([0, 1, 3, 40]))
            new = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 5])))
            text = text[:a] + new + text[b:]
            tree.edit(a, b, new)
            assert tree.text == text and tree.tokens.total() == len(ids_of(text))


def test_pieces_and_trees_of_documents(spark):
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", MARK, "end.\n<|endoftext|>\nnext", "x " * 1500 + MARK + " y" * 30, "plain text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = Counter()
    for i, text in enumerate(texts):
        ids = np.array(ids_of(text) + [0], dtype="<u4")
        for at in range(0, len(ids), 1024):
            part = ids[at:at + 1024]
            want[(i, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pack.pack(docs).collect()) == want
    assert {r.doc_id: r.n_tokens for r in tt.build_trees(docs).collect()} == {i: len(ids_of(t)) for i, t in enumerate(texts)}
