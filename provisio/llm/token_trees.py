"""Edit-aware token counts with segment trees (operator 4).

A text is cut into leaves of about ``LEAF_PIECES`` words at single spaces
between visible characters, where a pre-token always begins, so the token
count of the text is the sum over its leaves. A tree of sums over the leaves
(code points and tokens) is kept for each document.

An edit replaces a span of code points. The tree finds the leaves it touches;
a neighbouring leaf joins when the edit comes within ``CONTEXT`` characters
of the cut between them, for then the cut may no longer be one. Only those
leaves are encoded again; if their number stays the same, the sums on the
paths to the root are updated, else the inner sums are built anew from the
leaves (no text is encoded for that).

Edge cases: a null or empty text has one empty leaf and 0 tokens. A text
without such a space is one leaf. Edits apply in order, each to the text that
the edits before it left; spans are cut to the text's length, and null
replacements are empty. Without edits (null or empty) nothing is encoded.
A very long text's tree is one row of one task; its depth is the logarithm of
its leaves. Rows are independent, so repeated rows, ties and null ids need no rule. An
empty table gives no rows. Extra columns are carried along, and columns of the
result's names are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from .bpe import Encoder, broadcast_tokenizer, encoder_of
from .common import map_batches

LEAF_PIECES = 64
CONTEXT = 2
_CUT = re.compile(r"(?<=\S) (?=\S)")
EDITS = "array<struct<start: long, stop: long, replacement: string>>"


def cut_leaves(text: str, leaf_pieces: int = LEAF_PIECES) -> list[str]:
    """The text in leaves; every leaf but the first begins with a space."""
    at = [0, *[m.start() for m in _CUT.finditer(text)][leaf_pieces - 1::leaf_pieces], len(text)]
    return [text[a:b] for a, b in zip(at, at[1:])]


def _count(encoder: Encoder, leaf: str) -> int:
    """Tokens of a leaf; its first piece keeps its leading space."""
    data = leaf.encode("utf-8", "replace")
    if data[:1] == b" ":
        cut = encoder.pieces(data[1:])
        if cut is not None:
            return sum(map(len, encoder.of_pieces(cut))) // 4
        return len(encoder.whole(data)) // 4
    return len(encoder.encode(data)) // 4


class SumTree:
    """Sums over leaves in one array: the node k has children 2k and 2k + 1."""

    def __init__(self, leaves: list[int] | None = None, nodes: list[int] | None = None) -> None:
        if nodes is None:
            size = 1
            while size < len(leaves):
                size *= 2
            nodes = [0] * size + leaves + [0] * (size - len(leaves))
            for k in range(size - 1, 0, -1):
                nodes[k] = nodes[2 * k] + nodes[2 * k + 1]
        self.nodes, self.size = nodes, len(nodes) // 2

    def total(self) -> int:
        return self.nodes[1]

    def set(self, leaf: int, value: int) -> None:
        k = self.size + leaf
        change = value - self.nodes[k]
        while k:
            self.nodes[k] += change
            k //= 2

    def find(self, position: int) -> tuple[int, int]:
        """(leaf, its start) for a position below the total."""
        k, start = 1, 0
        while k < self.size:
            k *= 2
            if position >= start + self.nodes[k]:
                start += self.nodes[k]
                k += 1
        return k - self.size, start


class TokenTree:
    """A document's leaves with sums of code points and tokens."""

    def __init__(self, encoder: Encoder, text: str, chars: list[int] | None = None, tokens: list[int] | None = None,
                 n_leaves: int = 0) -> None:
        self.encoder, self.text, self.encoded_chars = encoder, text, 0
        if chars is None:
            leaves = cut_leaves(text)
            self.n_leaves = len(leaves)
            self.chars = SumTree([len(x) for x in leaves])
            self.tokens = SumTree([_count(encoder, x) for x in leaves])
        else:
            self.n_leaves, self.chars, self.tokens = n_leaves, SumTree(nodes=chars), SumTree(nodes=tokens)

    def _leaf(self, tree: SumTree, i: int) -> int:
        return tree.nodes[tree.size + i]

    def edit(self, start: int, stop: int, replacement: str) -> None:
        n = len(self.text)
        start = min(max(start, 0), n)
        stop = min(max(stop, start), n)
        if n:
            a, a_start = self.chars.find(min(start, n - 1))
            b, b_start = self.chars.find(min(max(stop - 1, start), n - 1))
        else:
            a = b = a_start = b_start = 0
        b_stop = b_start + self._leaf(self.chars, b)
        while a > 0 and start - a_start < CONTEXT:
            a -= 1
            a_start -= self._leaf(self.chars, a)
        while b + 1 < self.n_leaves and b_stop - stop < CONTEXT:
            b += 1
            b_stop += self._leaf(self.chars, b)
        region = self.text[a_start:start] + replacement + self.text[stop:b_stop]
        self.text = self.text[:start] + replacement + self.text[stop:]
        leaves = cut_leaves(region)
        if len(leaves) > 1 and len(leaves) != b - a + 1 and len(leaves[-1]) < len(leaves[0]) // 2:
            leaves[-2:] = [leaves[-2] + leaves[-1]]       # no stub of a leaf
        counts = [_count(self.encoder, x) for x in leaves]
        self.encoded_chars += len(region)
        if len(leaves) == b - a + 1:
            for i, (x, tokens) in enumerate(zip(leaves, counts), a):
                self.chars.set(i, len(x))
                self.tokens.set(i, tokens)
            return
        old = range(self.n_leaves)
        chars = [self._leaf(self.chars, i) for i in old]
        tokens = [self._leaf(self.tokens, i) for i in old]
        chars[a:b + 1], tokens[a:b + 1] = [len(x) for x in leaves], counts
        self.n_leaves, self.chars, self.tokens = len(chars), SumTree(chars), SumTree(tokens)


_STATE = ("n_tokens", "n_leaves", "tree_chars", "tree_tokens")
_COUNTS = ("edited_text", "edited_tokens", "encoded_chars")


def _fields(df: DataFrame, skip: tuple[str, ...]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in skip)


def build_trees(docs: DataFrame, *, tokenizer_path: str | None = None) -> DataFrame:
    """``docs`` with n_tokens, n_leaves, tree_chars, tree_tokens."""
    raw = broadcast_tokenizer(docs.sparkSession, tokenizer_path)

    def run(batches):
        encoder = encoder_of(raw.value)
        for b in batches:
            trees = [TokenTree(encoder, t or "") for t in b["text"]]
            yield b | {"n_tokens": [t.tokens.total() for t in trees], "n_leaves": [t.n_leaves for t in trees],
                       "tree_chars": [t.chars.nodes for t in trees], "tree_tokens": [t.tokens.nodes for t in trees]}

    schema = _fields(docs, _STATE) + ", n_tokens long, n_leaves int, tree_chars array<long>, tree_tokens array<long>"
    return map_batches(docs.drop(*_STATE), run, schema)


def apply_edits(trees: DataFrame, *, tokenizer_path: str | None = None, keep_text: bool = True) -> DataFrame:
    """Apply the ``edits`` column (see ``EDITS``) to documents with trees: the
    trees and ``text`` are brought up to date, edited_tokens is the new count
    (n_tokens keeps the old one), encoded_chars the code points encoded again."""
    raw = broadcast_tokenizer(trees.sparkSession, tokenizer_path)

    def run(batches):
        encoder = encoder_of(raw.value)
        for b in batches:
            new = []
            for text, chars, tokens, n_leaves, edits in zip(b["text"], b["tree_chars"], b["tree_tokens"], b["n_leaves"], b["edits"]):
                tree = TokenTree(encoder, text or "", list(chars), list(tokens), n_leaves)
                for e in edits or []:
                    tree.edit(e["start"] or 0, e["stop"] or 0, e["replacement"] or "")
                new.append(tree)
            out = b | {"n_leaves": [t.n_leaves for t in new], "tree_chars": [t.chars.nodes for t in new],
                       "tree_tokens": [t.tokens.nodes for t in new], "edited_tokens": [t.tokens.total() for t in new],
                       "encoded_chars": [t.encoded_chars for t in new]}
            out["text"] = [t.text for t in new] if keep_text else [None] * len(new)
            yield out

    schema = _fields(trees.drop("edited_tokens", "encoded_chars"), ()) + ", edited_tokens long, encoded_chars long"
    return map_batches(trees.drop("edited_tokens", "encoded_chars"), run, schema)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """Join edits (doc_id, start, stop, replacement, seq) to their documents,
    in order of ``seq``; a document's edits are one list."""
    lists = edits.groupBy("doc_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "replacement"))),
        lambda e: F.struct(e["start"].cast("long").alias("start"), e["stop"].cast("long").alias("stop"),
                           e["replacement"].alias("replacement"))).alias("edits"))
    return trees.drop("edits").join(lists, "doc_id", "left")
