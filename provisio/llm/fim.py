"""Fill-in-the-middle transformation (operator 11).

A text of n units (a word with the white space before it; trailing white space
is one more) is cut after two of them into prefix, middle and suffix, which are
put in another order behind the marks ``<P>``, ``<S>`` and ``<M>``. Whether and
how is drawn from a hash of the document's id, so a rerun draws the same.

Where the k-th unit ends is found by content-defined chunk memoization:

1. A rolling hash over the last ``WINDOW`` bytes cuts every text into chunks of
   ``MIN_CHUNK`` to ``MAX_CHUNK`` bytes, about ``MIN_CHUNK + 2^CHUNK_BITS``
   (shorter at a text's end). Passages that texts share get the same cuts from
   soon after their start on.
2. Each chunk has a boundary summary: word ends inside it, code points, and
   whether it begins and ends within a word. Summaries are kept by content: a
   dictionary finds a chunk by its hash and compares its bytes, so a chunk is
   summarised once while it is kept, and never taken for another.
3. Two neighbouring summaries combine into one: word ends add up, and one more
   counts where a word meets white space (or the text's end) at the boundary.
   Running counts name the chunk that holds a cut; only that chunk is read
   again for the exact place.

A task streams its texts; nothing is shuffled. The cache holds at most
``CACHE_BYTES`` of chunks in a worker and starts anew when full.

Edge cases: a null text is empty; an empty text has no units and stays plain,
and so does one that holds a mark already. Null doc_ids hash as ''. Rows
sharing a doc_id draw the same numbers, and equal cuts are fine (an empty
middle). A text is never cut inside a code point or a word, and one very long
text or word is one row's work, in time proportional to its length. Repeated
rows give repeated results. An empty table gives no rows. Extra columns are
dropped unless named in ``keep``; a result replaces one of its name.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import ASCII_SPACE, fresh, kept_fields, map_batches, utf8

SEED = "42"
FIM_PERCENT = 50
SPM_PERCENT = 80             # of the transformed ones
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

WINDOW = 32                  # bytes the rolling hash sees: its 32 bits forget older ones
CHUNK_BITS = 8               # a cut falls behind one byte in 2^CHUNK_BITS
MIN_CHUNK, MAX_CHUNK = 128, 2048
CACHE_BYTES = 48 << 20
CACHE_ENTRY = 200            # bytes of a kept chunk beside its content

_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
_CONTINUATION = bytes(range(0x80, 0xC0))
_WORD_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
_GEAR = np.random.default_rng(42).integers(0, 1 << 32, 256, dtype=np.uint32)

Summary = tuple[int, int, bool, bool]      # word ends inside, code points, begins in white space, ends in a word


def cut_candidates(data: bytes, bits: int = CHUNK_BITS) -> np.ndarray:
    """Places behind which the rolling hash asks for a cut. The hash of a place
    is the sum of its last ``WINDOW`` bytes' numbers, each shifted by its
    distance; doubling the window five times builds it for all places at once."""
    value = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    width = 1
    while width < WINDOW:
        wider = value.copy()
        wider[width:] += value[:-width] << np.uint32(width)
        value, width = wider, 2 * width
    return np.flatnonzero(value >> np.uint32(32 - bits) == 0) + 1


def chunks(data: bytes) -> list[int]:
    """End of every chunk of a text."""
    ends, last, n = [], 0, len(data)
    for place in (cut_candidates(data).tolist() if n > MIN_CHUNK else []):
        while place - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if place - last >= MIN_CHUNK:
            last = place
            ends.append(last)
    while n - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def summarise(chunk: bytes) -> Summary:
    ends_in_word = chunk[-1] not in ASCII_SPACE
    return (len(chunk.split()) - ends_in_word, len(chunk.translate(None, _CONTINUATION)), chunk[0] in ASCII_SPACE, ends_in_word)


class ChunkCache:
    """Summaries of chunks by their content, bounded in bytes."""

    def __init__(self, most_bytes: int = CACHE_BYTES) -> None:
        self.most, self.held, self.kept, self.hits, self.misses = most_bytes, 0, {}, 0, 0

    def of(self, chunk: bytes) -> Summary:
        found = self.kept.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        self.misses += 1
        if self.held > self.most:
            self.kept, self.held = {}, 0
        self.kept[chunk] = found = summarise(chunk)
        self.held += len(chunk) + CACHE_ENTRY
        return found


class Located:
    """A text's running counts by chunk: how many units it has, and where
    (byte and code point) the k-th ends."""

    def __init__(self, data: bytes, cache: ChunkCache) -> None:
        self.data, self.ends = data, chunks(data)
        self.words, self.points, self.at_boundary = [], [], []
        words = points = last = 0
        in_word = False
        for end in self.ends:
            inside, n_points, begins_blank, ends_in_word = cache.of(data[last:end])
            boundary = in_word and begins_blank      # the word before ends at the chunk's first byte
            words += boundary
            self.at_boundary.append(words)
            words, points, in_word, last = words + inside, points + n_points, ends_in_word, end
            self.words.append(words)
            self.points.append(points)
        self.n = words + bool(data)                  # the last word, or the white space behind it

    def end_of(self, k: int) -> tuple[int, int]:
        """(byte, code point) behind the k-th unit; (0, 0) for none."""
        if k <= 0:
            return 0, 0
        if k >= self.n:
            return len(self.data), self.points[-1] if self.points else 0
        c = bisect_left(self.words, k)
        start, points = (self.ends[c - 1], self.points[c - 1]) if c else (0, 0)
        nth = k - self.at_boundary[c]
        if nth <= 0:
            return start, points                     # a word that ends with the chunk before
        chunk = self.data[start:self.ends[c]]
        for _, found in zip(range(nth), _WORD_END.finditer(chunk)):
            pass
        return start + found.end(), points + len(chunk[:found.end()].translate(None, _CONTINUATION))


def draws(doc_id: object, seed: str = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, *, keep: Sequence[str] = ("doc_id",), seed: str = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """The ``keep`` columns with n (units), form (plain, psm or spm),
    prefix_chars and middle_chars (null if plain) and the output text."""
    own, schema = kept_fields(docs, keep, RESULT)
    id_name, body_name = fresh(docs, "fim_id", "fim_body")
    slim = docs.select(*own, F.col("doc_id").cast("string").alias(id_name), utf8().alias(body_name))
    p, s, m = _MARKS

    def run(batches):
        cache = ChunkCache()
        for b in batches:
            out = {"n": [], "form": [], "prefix_chars": [], "middle_chars": [], "output": []}
            for doc_id, data in zip(b.pop(id_name), b.pop(body_name)):
                h1, h2, h3, h4 = draws(doc_id, seed)
                text = Located(data, cache)
                n, form = text.n, "plain"
                if data and h3 % 100 < fim_percent and not any(mark in data for mark in _MARKS):
                    form = "spm" if h4 % 100 < spm_percent else "psm"
                    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
                    (lo, lo_points), (hi, hi_points) = text.end_of(first), text.end_of(second)
                    prefix, middle, suffix = data[:lo], data[lo:hi], data[hi:]
                    data = b"".join((s, suffix, p, prefix, m, middle) if form == "spm" else (p, prefix, s, suffix, m, middle))
                    out["prefix_chars"].append(lo_points)
                    out["middle_chars"].append(hi_points - lo_points)
                else:
                    out["prefix_chars"].append(None)
                    out["middle_chars"].append(None)
                out["n"].append(n)
                out["form"].append(form)
                out["output"].append(data.decode("utf-8", "replace"))
            yield b | out

    return map_batches(slim, run, schema, max_bytes=4 << 20)


def restore(output: Column, form: Column) -> Column:
    """The text behind an output: its parts lie between the marks, each of
    which a transformed output holds once."""
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    after = lambda c, mark: F.substring_index(c, mark, -1)
    before = lambda c, mark: F.substring_index(c, mark, 1)
    spm = F.concat(before(after(body, PREFIX), MIDDLE), after(body, MIDDLE), before(body, PREFIX))
    psm = F.concat(before(body, SUFFIX), after(body, MIDDLE), before(after(body, SUFFIX), MIDDLE))
    return F.when(form == "spm", spm).when(form == "psm", psm).otherwise(output)
