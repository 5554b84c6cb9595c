"""Operator 9: ids against the ``tokenizers`` library, every id in one piece."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from provisio.llm import bpe, pack

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
    ENCODER = bpe.encoder_of(f.read())


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def check(got, texts):
    """texts: list of (doc_id, text), repeated rows included."""
    by_row = Counter()
    for doc_id, text in texts:
        ids = np.array(ids_of(text or "") + [0], dtype="<u4")
        for at in range(0, len(ids), 1024):
            part = ids[at:at + 1024]
            by_row[(doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == by_row
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, r.sequence_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length, total in sorted(parts):
            assert offset == at
            at += length
        assert at == total <= 1024
    return sequences


def test_every_id_is_packed_once(documents, rows):
    sequences = check(pack.pack(documents).collect(), [(r["doc_id"], r["text"]) for r in rows])
    fill = [parts[0][2] for parts in sequences.values()]
    padding = sum(1024 - n for n in fill if n & (n - 1))
    assert padding < 0.03 * sum(fill)


def test_edge_rows(edge, empty):
    check(pack.pack(edge).collect(), [(r.doc_id, r.text) for r in edge.collect()])
    assert pack.pack(empty).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab C'sé1 .!\n\t\r\x0b  　  \x1c🙂ñ東<|>_-"), max_size=40))
def test_cached_pieces_give_the_library_ids(text):
    assert np.frombuffer(ENCODER.encode(text.encode()), dtype="<u4").tolist() == ids_of(text)


def test_histogram_packing_uses_every_length_once():
    rng = random.Random(3)
    histogram = {n: rng.randrange(1, 400) for n in rng.sample(range(1, 1025), 300)}
    patterns = pack.pack_histogram(histogram)
    used = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 1024
        for n in pattern:
            used[n] += count
    assert used == histogram
    # slots: every rank of every length in one place, no two in the same place
    places = set()
    for length, lo, hi, first, offset in pack.pattern_slots(patterns):
        for rank in range(lo, hi):
            places.add((length, rank))
    assert len(places) == sum(histogram.values())
    needed = sum(n * c for n, c in histogram.items()) / 1024
    assert sum(c for _, c in patterns) <= 1.06 * needed + 1      # sparse bins; dense ones pack tighter
