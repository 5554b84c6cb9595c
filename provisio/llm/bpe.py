"""Byte-level BPE ids of whole texts, with a word cache.

The tokenizer file (``tokenizers`` JSON, byte-level BPE) is read on the driver
and broadcast; it has a fixed size. Its merge order equals its id order, so the
same vocabulary drives the faster ``tiktoken`` encoder; tests compare both
libraries' ids on whole texts.

The file's added tokens (``<|endoftext|>``) are found first, anywhere in a text
and the longest of those at one place; each is its one id, and the parts between
are encoded by themselves, as ``tokenizers`` does.

A single space (or newline) between two visible characters always begins a new
pre-token, so a text is cut there and each piece's ids are cached as bytes.
Texts with longer white-space runs or other Unicode spaces are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array

from pyspark import Broadcast
from pyspark.sql import SparkSession

# Fixed value: the byte-level pre-tokenizer's public pattern.
PRETOKEN_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# White space other than lone spaces and newlines; the last group needs a closer look.
_IRREGULAR = (b"  ", b"\n\n", b" \n", b"\n ", b"\t", b"\r", b"\x0b", b"\x0c", b"\xc2\x85", b"\xc2\xa0",
              b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_WIDE_SPACE = re.compile(rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]")

CACHE_ENTRIES = 200_000    # words kept per Python worker; a full cache starts anew
CACHE_WORD_BYTES = 64      # longer pieces are not kept
_ENCODERS: dict[str, "Encoder"] = {}


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def broadcast_tokenizer(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The tokenizer file's bytes (a fixed size) for every executor."""
    with open(path or default_tokenizer_path(), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoder_of(raw: bytes) -> "Encoder":
    """The worker's encoder for a tokenizer file (kept between tasks)."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(raw)
    return _ENCODERS[key]


def _byte_of_char() -> dict[str, int]:
    """Printable Latin-1 bytes stand for themselves; the others, in order,
    for the characters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, raw: bytes) -> None:
        import tiktoken

        spec = json.loads(raw)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t["content"]}
        for t in spec.get("added_tokens", []):
            # the cuts at white space rely on added tokens without any, matched as they are
            if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]):
                raise ValueError(f"added token {t['content']!r} takes white space or whole words only: not supported")
        byte_of = _byte_of_char()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in added}
        self._encode = tiktoken.Encoding("byte_bpe", pat_str=PRETOKEN_PATTERN, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary
        self._cache: dict[bytes, bytes] = {}
        self._added = {content.encode(): i.to_bytes(4, "little") for content, i in added.items()}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._marks = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")") if added else None

    def _has_added(self, text: bytes) -> bool:
        return any(mark in text for mark in self._added)

    def whole(self, text: bytes) -> bytes:
        """Ids of a text, without cuts but those at added tokens."""
        if self._has_added(text):
            parts = self._marks.split(text)
            return b"".join(self._added[x] if i % 2 else self.encode(x) for i, x in enumerate(parts))
        return self._plain(text)

    def _plain(self, text: bytes) -> bytes:
        """Ids of a text without added tokens."""
        ids = array("I", self._encode(text.decode("utf-8", "replace")))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def pieces(self, text: bytes) -> list[bytes] | None:
        """The text cut at lone spaces and newlines (each piece begins with
        its separator), or None if the text has other white space or an added token."""
        if not text or text[:1] in b" \n" or text[-1:] in b" \n" or any(w in text for w in _IRREGULAR) \
                or (b"\xe2\x80" in text and _WIDE_SPACE.search(text)) or self._has_added(text):
            return None
        return text.replace(b"\n", b" \n").split(b" ")

    def encode(self, text: bytes) -> bytes:
        cut = self.pieces(text)
        if cut is None:
            return self.whole(text) if text else b""
        return self._plain(cut[0]) + b"".join(self.of_pieces(cut[1:]))

    def of_pieces(self, cut: list[bytes]) -> list[bytes]:
        """Ids of pieces that follow a separator (a newline is kept in front
        of the piece, a space is not)."""
        cache = self._cache
        found = list(map(cache.get, cut))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    piece = cut[i]
                    ids = cache.get(piece)
                    if ids is None:
                        ids = self._plain(piece if piece[:1] == b"\n" else b" " + piece)
                        if len(piece) <= CACHE_WORD_BYTES:
                            if len(cache) >= CACHE_ENTRIES:
                                cache.clear()
                            cache[piece] = ids
                    found[i] = ids
        return found
