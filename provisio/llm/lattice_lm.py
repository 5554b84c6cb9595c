"""Language-model scores by subword lattices (operator 5).

Words are counted over all training documents. A fixed subword vocabulary
with its own scores (a ``sentencepiece`` file) gives the first piece
probabilities; expectation-maximisation fits them to the corpus until a round
over all counted words gains almost nothing. A word's probability is the sum over all its
segmentations (forward recursion in log space); a text's is the product over
its words and one end.

Scoring is one pass over the texts. The counts and lattice scores of frequent
words (at most ``FREQUENT_WORDS``, chosen by a count threshold) are broadcast;
the others get their lattice score in the task, and their count for the base
score by a join on the word. So a hot word never reaches a shuffle.

Words of equal length share a vectorised lattice; a long word with few of its
length is walked place by place, at some microseconds a character.

Edge cases: a null or empty text is one end. Very long texts are scored whole,
and so are long words (a megabyte without a space takes seconds). Words with
equal counts are all broadcast or none, so ties change no score. A null doc_id counts as training
(remainder of ''). Characters outside the vocabulary are spelled by byte
pieces, so every text has a finite score. Repeated rows are scored one by one,
and all of them train. Without training documents the vocabulary's own scores
are used, and the base score is that of an empty corpus. An empty table gives
no rows. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from array import array
from collections import Counter
from math import exp, log

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpoint_dir
from .common import land, map_batches, utf8

FREQUENT_WORDS = 200_000     # words whose count and score are broadcast
FREQUENT_BYTES = 64          # longer words are never broadcast
COUNTER_WORDS = 300_000      # distinct words a counting task holds before it hands them on
LATTICE_WORDS = 20_000       # words in one vectorised lattice
LATTICE_CHARS = 200_000      # characters in one vectorised lattice
WALK_WORDS, WALK_CHARS = 24, 32     # fewer words of more characters are walked one by one
WALK_BLOCK = 1 << 16         # characters of a walked word whose arcs are held at once
TOLERANCE = 2e-3             # rounds end when one lowers the negative log likelihood by a smaller share
MOST_ROUNDS = 30             # of each kind; a few are enough
WARM_COUNT = 3               # the first rounds read only words that occur so often
PRIOR_PIECES = 0.1           # weight of the vocabulary's own scores against the corpus
END_SHARE = 1e-3             # probability of the end before any training
HOLD_OUT = (7, 2)            # crc32(doc_id) mod 7 = 2 is held out

_SLOT_BITS = 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(1_000_003)
_EMPTY = np.uint64(0)


def default_pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def held_out(doc_id: Column, modulus: int = HOLD_OUT[0], remainder: int = HOLD_OUT[1]) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


class Pieces:
    """A subword vocabulary with log probabilities (natural) and the lattice."""

    def __init__(self, texts: list[str], byte_ids: list[int], log_p: np.ndarray, log_end: float) -> None:
        self.log_p, self.log_end, self.byte_ids = log_p, log_end, np.asarray(byte_ids)
        self.single = {t: i for i, t in enumerate(texts) if len(t) == 1}
        longer = [(t, i) for i, t in enumerate(texts) if len(t) > 1]
        self.longest = max((len(t) for t, _ in longer), default=1)
        self.keys = np.zeros(1 << _SLOT_BITS, dtype=np.uint64)
        self.ids = np.full(1 << _SLOT_BITS, -1, dtype=np.int32)
        self.maybe = np.zeros(1 << _SLOT_BITS, dtype=bool)      # slots that some piece's hash names
        with np.errstate(over="ignore"):
            for text, i in longer:
                h = np.uint64(0)
                for ch in text:
                    h = h * _BASE + np.uint64(ord(ch) + 1) * _MULTIPLIER
                slot = int(h >> np.uint64(64 - _SLOT_BITS))
                self.maybe[slot] = True
                while self.keys[slot] != _EMPTY:
                    slot = (slot + 1) % len(self.keys)
                self.keys[slot], self.ids[slot] = h, i

    @classmethod
    def from_file(cls, raw: bytes) -> "Pieces":
        """The vocabulary's own scores. A unigram file's are log
        probabilities; a merge file's are negative ranks, read as a Zipf law."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=raw)
        texts, scores, byte_ids = [], [], [0] * 256
        for i in range(sp.get_piece_size()):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                texts.append("")
            elif sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[1:-1], 16)] = i
                texts.append("")
            else:
                texts.append(sp.id_to_piece(i))
            scores.append(sp.get_score(i))
        scores = np.asarray(scores)
        usable = np.array([bool(t) for t in texts])
        usable[byte_ids] = True
        ranked = scores[usable]
        if np.all(ranked == np.round(ranked)):
            log_p = -np.log(np.maximum(0.0, -scores) + 10.0)
            log_p[byte_ids] = -np.log(len(scores) + 10.0)
        else:
            log_p = scores.astype(np.float64)
            log_p[byte_ids] = ranked.min() - 1.0
        log_p = np.where(usable, log_p, -np.inf)
        log_p -= np.logaddexp.reduce(log_p[usable]) - np.log1p(-END_SHARE)
        return cls(texts, byte_ids, log_p, float(np.log(END_SHARE)))

    def with_scores(self, log_p: np.ndarray, log_end: float) -> "Pieces":
        other = object.__new__(Pieces)
        other.__dict__ = self.__dict__ | {"log_p": log_p, "log_end": log_end}
        return other

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, piece ids) of the hashes that are pieces."""
        slot = h >> np.uint64(64 - _SLOT_BITS)
        rows = np.flatnonzero(self.maybe[slot])
        h, slot = h[rows], slot[rows].astype(np.int64)
        ids = np.full(len(rows), -1, dtype=np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            key = self.keys[slot[todo]]
            hit = key == h[todo]
            ids[todo[hit]] = self.ids[slot[todo[hit]]]
            todo = todo[~hit & (key != _EMPTY)]
            slot[todo] = (slot[todo] + 1) % len(self.keys)
        hit = ids >= 0
        return rows[hit], ids[hit]

    def _spelled(self, code: int) -> np.ndarray:
        """Pieces of one character: itself, or its UTF-8 bytes."""
        i = self.single.get(chr(code))
        return np.array([i]) if i is not None else self.byte_ids[list(chr(code).encode("utf-8", "replace"))]

    def _characters(self, text: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """Codes, their places among the distinct ones, and the distinct ones'
        pieces and log probabilities."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        known, place = np.unique(codes, return_inverse=True)
        spelled = [self._spelled(int(c)) for c in known]
        return codes, place.reshape(codes.shape), spelled, np.array([self.log_p[p].sum() for p in spelled])

    @staticmethod
    def _hashed(codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (codes.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER

    def scores(self, words: list[bytes], weights: np.ndarray | None = None, expected: np.ndarray | None = None) -> np.ndarray:
        """Natural log probability of each word. With ``weights`` the expected
        piece counts, times each word's weight, are added to ``expected``."""
        out = np.zeros(len(words))
        texts = ["▁" + w.decode("utf-8", "replace") for w in words]
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(sizes, kind="stable")
        bounds = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
        for lo, hi in zip(bounds, bounds[1:]):
            size = int(sizes[order[lo]])
            step = max(1, min(LATTICE_WORDS, LATTICE_CHARS // size))
            if size > WALK_CHARS and min(step, hi - lo) < WALK_WORDS:
                for r in order[lo:hi]:
                    out[r] = self._walk(texts[r], None if weights is None else float(weights[r]), expected)
                continue
            for at in range(lo, hi, step):
                rows = order[at:min(at + step, hi)]
                out[rows] = self._lattice([texts[r] for r in rows], size,
                                          None if weights is None else weights[rows], expected)
        return out

    def _lattice(self, texts: list[str], n: int, weights: np.ndarray | None, expected: np.ndarray | None) -> np.ndarray:
        codes, place, spelled, single = self._characters("".join(texts))
        codes, place = codes.reshape(len(texts), n).T, place.reshape(len(texts), n).T
        chars = self._hashed(codes)
        prefix = [np.zeros(len(texts), dtype=np.uint64)]
        powers = [np.uint64(1)]
        with np.errstate(over="ignore"):
            for j in range(n):
                prefix.append(prefix[-1] * _BASE + chars[j])
            for _ in range(self.longest):
                powers.append(powers[-1] * _BASE)
        alpha = [np.zeros(len(texts))]
        arcs: list[tuple[int, int, np.ndarray, np.ndarray]] = []       # from, to, rows, piece ids
        for j in range(1, n + 1):
            one = alpha[j - 1] + single[place[j - 1]]
            best = one.copy()
            found = []
            for size in range(2, min(j, self.longest) + 1):
                with np.errstate(over="ignore"):
                    rows, ids = self._find(prefix[j] - prefix[j - size] * powers[size])
                if len(rows):
                    way = alpha[j - size][rows] + self.log_p[ids]
                    best[rows] = np.maximum(best[rows], way)
                    found.append((rows, way))
                    if weights is not None:
                        arcs.append((j - size, j, rows, ids))
            total = np.exp(one - best)          # log-sum-exp over the arcs that end here
            for rows, way in found:
                total[rows] += np.exp(way - best[rows])
            alpha.append(best + np.log(total))
        if weights is not None:
            self._expect(alpha, arcs, single, place, spelled, weights, expected)
        return alpha[n]

    def _arcs(self, codes: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(from, to, piece ids) of all longer pieces that start in lo..hi."""
        chars = self._hashed(codes[lo:hi + self.longest])
        h, starts, ends, pieces = chars, [], [], []
        for size in range(2, min(self.longest, len(chars)) + 1):
            with np.errstate(over="ignore"):
                h = h[:-1] * _BASE + chars[size - 1:]
            rows, ids = self._find(h[:hi - lo])
            starts.append(rows + lo)
            ends.append(rows + lo + size)
            pieces.append(ids)
        join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, dtype=np.int64)
        return join(starts), join(ends), join(pieces)

    @staticmethod
    def _fill(sums: array, places: range, back: int, ones: list[float], at: np.ndarray, other: np.ndarray, log_p: np.ndarray) -> None:
        """One block of a recursion: each place's sum over its single character
        (from the place ``back``) and its arcs (place ``at``, from ``other``)."""
        order = np.argsort(at, kind="stable")
        low = min(places[0], places[-1])
        first = np.searchsorted(at[order], np.arange(low, low + len(places) + 1)).tolist()
        other, log_p = other[order].tolist(), log_p[order].tolist()
        for place in places:
            a, b = first[place - low], first[place - low + 1]
            one = sums[place + back] + ones[place - low]
            if a < b:
                ways = [sums[o] + p for o, p in zip(other[a:b], log_p[a:b])]
                best = max(one, *ways)
                one = best + log(exp(one - best) + sum([exp(w - best) for w in ways]))
            sums[place] = one

    def _walk(self, text: str, weight: float | None, expected: np.ndarray | None) -> float:
        """``_lattice`` of one long word, place by place; arcs are found for a
        block of places at once."""
        codes, place, spelled, single = self._characters(text)
        n, ones = len(codes), single[place]
        alpha = array("d", bytes(8 * (n + 1)))
        for lo in range(0, n, WALK_BLOCK):
            hi = min(n, lo + WALK_BLOCK)
            starts, ends, ids = self._arcs(codes, max(0, lo + 1 - self.longest), hi)
            here = (ends > lo) & (ends <= hi)
            self._fill(alpha, range(lo + 1, hi + 1), -1, ones[lo:hi].tolist(), ends[here], starts[here], self.log_p[ids[here]])
        if weight is None:
            return alpha[n]
        beta, chars = array("d", bytes(8 * (n + 1))), np.zeros(len(spelled))
        before, after = np.frombuffer(alpha), np.frombuffer(beta)
        for lo in range((n - 1) // WALK_BLOCK * WALK_BLOCK, -1, -WALK_BLOCK):
            hi = min(n, lo + WALK_BLOCK)
            starts, ends, ids = self._arcs(codes, lo, hi)
            self._fill(beta, range(hi - 1, lo - 1, -1), 1, ones[lo:hi].tolist(), starts, ends, self.log_p[ids])
            expected += np.bincount(ids, weight * np.exp(before[starts] + self.log_p[ids] + after[ends] - alpha[n]), len(expected))
            chars += np.bincount(place[lo:hi], weight * np.exp(before[lo:hi] + ones[lo:hi] + after[lo + 1:hi + 1] - alpha[n]), len(spelled))
        for c, ids in zip(chars, spelled):
            np.add.at(expected, ids, c)
        return alpha[n]

    def _expect(self, alpha, arcs, single, place, spelled, weights, expected) -> None:
        """Backward recursion; adds each arc's posterior times the weight."""
        n = len(alpha) - 1
        beta = [np.zeros(0)] * n + [np.zeros(len(weights))]
        by_start: dict[int, list] = {}
        for arc in arcs:
            by_start.setdefault(arc[0], []).append(arc)
        chars = np.zeros(len(spelled))
        for i in range(n - 1, -1, -1):
            one = single[place[i]] + beta[i + 1]
            best, found = one.copy(), []
            for _, j, rows, ids in by_start.get(i, ()):
                way = self.log_p[ids] + beta[j][rows]
                best[rows] = np.maximum(best[rows], way)
                found.append((rows, ids, way))
            share = np.exp(one - best)
            total, parts = share.copy(), []
            for rows, ids, way in found:
                part = np.exp(way - best[rows])
                total[rows] += part
                parts.append(part)
            beta[i] = best + np.log(total)
            # posterior of passing i, split over the arcs that start here
            through = np.exp(alpha[i] + beta[i] - alpha[n]) * weights / total
            chars += np.bincount(place[i], share * through, len(spelled))
            for (rows, ids, _), part in zip(found, parts):
                expected += np.bincount(ids, part * through[rows], len(expected))
        for c, ids in zip(chars, spelled):
            np.add.at(expected, ids, c)


def count_words(docs: DataFrame) -> DataFrame:
    """(word binary, n) over all texts: counted in tasks, then by an aggregate."""

    def run(batches):
        held: Counter = Counter()
        for b in batches:
            for text in b["body"]:
                held.update(text.lower().split())
                if len(held) > COUNTER_WORDS:
                    yield {"word": list(held), "n": list(held.values())}
                    held = Counter()
        if held:
            yield {"word": list(held), "n": list(held.values())}

    return map_batches(docs.select(utf8().alias("body")), run, "word binary, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def _expected_pieces(counts: DataFrame, shared) -> list:
    """Expected counts of pieces over all counted words: at most one row a piece."""

    def run(batches):
        pieces = shared.value
        expected = np.zeros(len(pieces.log_p))
        for b in batches:
            pieces.scores(b["word"], np.asarray(b["n"], dtype=np.float64), expected)
        ids = np.flatnonzero(expected)
        yield {"piece": ids.tolist(), "n": expected[ids].tolist()}

    return map_batches(counts, run, "piece int, n double", max_bytes=2 << 20) \
        .groupBy("piece").agg(F.sum("n").alias("n")).collect()


def _maximise(pieces: Pieces, expected: np.ndarray, n_docs: int, own: np.ndarray) -> tuple[Pieces, float]:
    """The next piece probabilities and the share by which the words' negative
    log likelihood falls at least (the gain of the expected log likelihood)."""
    prior = PRIOR_PIECES * len(own)
    total = expected.sum() + prior + n_docs
    p = (expected + prior * own / own.sum()) / total
    with np.errstate(divide="ignore"):
        better = pieces.with_scores(np.log(p), float(np.log(n_docs / total)))
    seen = expected > 0
    before = expected[seen] @ pieces.log_p[seen] + n_docs * pieces.log_end
    after = expected[seen] @ better.log_p[seen] + n_docs * better.log_end
    return better, (after - before) / -before


def fit_pieces(counts: DataFrame, n_docs: int, raw: bytes, tolerance: float = TOLERANCE) -> Pieces:
    """Piece probabilities fitted to the counted words, from the vocabulary's
    own scores on: first over the words that occur ``WARM_COUNT`` times or more,
    which costs little and comes close, then over all words, each until a round
    gains less than ``tolerance``. What reaches the driver has the
    vocabulary's size."""
    pieces = Pieces.from_file(raw)
    if not n_docs:
        return pieces
    own = np.exp(pieces.log_p)
    for words, every in ((counts.where(F.col("n") >= WARM_COUNT), False), (counts, True)):
        for _ in range(MOST_ROUNDS):
            expected = np.zeros(len(own))
            shared = counts.sparkSession.sparkContext.broadcast(pieces)
            for r in _expected_pieces(words, shared):
                expected[r["piece"]] = r["n"]
            shared.unpersist()
            if not every and not expected.any():
                break
            pieces, gain = _maximise(pieces, expected, n_docs, own)
            if gain < tolerance:
                break
    return pieces


def _frequent(counts: DataFrame, most: int) -> list:
    """Words above a count threshold that at most ``most`` words pass. The
    threshold comes from a histogram of log-spaced bins (a few hundred rows)."""
    short = counts.where(F.octet_length("word") <= FREQUENT_BYTES)
    bin_of = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    bins = sorted(((r["b"], r["n"]) for r in short.groupBy(bin_of.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    taken, least = 0, None
    for b, n in bins:
        if taken + n > most:
            break
        taken, least = taken + n, b
    return short.where(bin_of >= least).collect() if least is not None else []


_SCORED = ("doc_id long, held_out boolean, n_tokens long, known_part long, base_part double, score double, "
           "words array<binary>, times array<int>")


def score_texts(docs: DataFrame, *, pieces_path: str | None = None, tolerance: float = TOLERANCE,
                frequent_words: int = FREQUENT_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    with open(pieces_path or default_pieces_path(), "rb") as f:
        raw = f.read()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    train = slim.where(~F.col("held_out"))
    counts = land(count_words(train), "word-counts")
    sums = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs = train.count()
    n_all, n_distinct = sums[1] + n_docs, sums[0] + (1 if n_docs else 0)
    unit = n_all + 1 * (n_distinct + 1)
    pieces = fit_pieces(counts, n_docs, raw, tolerance)
    frequent = _frequent(counts, frequent_words)
    words = [bytes(r["word"]) for r in frequent]
    shared = spark.sparkContext.broadcast((pieces, words, np.log10((np.array([r["n"] for r in frequent], dtype=np.float64) + 1) / unit),
                                           pieces.scores(words) / np.log(10.0)))
    end_base, end_score = float(np.log10((n_docs + 1) / unit)), pieces.log_end / float(np.log(10.0))
    end_known, model_key = 1 if n_docs else 0, uuid.uuid4().hex

    def run(batches):
        pieces, known, base_of, score_of = shared.value
        place = _places(model_key, known)
        base_of, score_of = np.append(base_of, 0.0), np.append(score_of, 0.0)
        for b in batches:
            out = {"doc_id": b["doc_id"], "held_out": b["held_out"], "n_tokens": [], "known_part": [], "base_part": [],
                   "score": [], "words": [], "times": []}
            rare_of = []
            for text in b["body"]:
                tokens = text.lower().split()
                at = np.array([place.get(w, -1) for w in tokens], dtype=np.int64)
                rare = Counter([tokens[i] for i in np.flatnonzero(at < 0)])
                rare_of.append(rare)
                out["n_tokens"].append(len(tokens) + 1)
                out["known_part"].append(int((at >= 0).sum()) + end_known)
                out["base_part"].append(float(base_of[at].sum()) + end_base)
                out["score"].append(float(score_of[at].sum()) + end_score)
                out["words"].append(list(rare))
                out["times"].append(list(rare.values()))
            distinct = list(set().union(*rare_of)) if rare_of else []
            value = dict(zip(distinct, (pieces.scores(distinct) / np.log(10.0)).tolist()))
            out["score"] = [s + sum(value[w] * n for w, n in rare.items()) for s, rare in zip(out["score"], rare_of)]
            yield out

    scored = map_batches(slim.select("doc_id", "held_out", utf8().alias("body")), run, _SCORED, max_bytes=8 << 20)
    # row ids are written with the rows, so later reads agree on them
    scored = land(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.*") \
        .join(counts, F.col("words") == F.col("word"), "left")
    per_row = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(unit)))).alias("base"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"))
    return (scored.select("row", "doc_id", "held_out", "n_tokens", "known_part", "base_part", "score").join(per_row, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("known_part") + F.coalesce("known", F.lit(0))).alias("n_known"),
                    F.lit(n_all).cast("long").alias("train_tokens"),
                    (F.col("base_part") + F.coalesce("base", F.lit(0.0))).alias("base_score"), "score"))


_PLACES: dict = {}


def _places(key: str, words: list[bytes]) -> dict[bytes, int]:
    """Word -> index, kept for one broadcast at a time in each worker."""
    if key not in _PLACES:
        _PLACES.clear()
        _PLACES[key] = {w: i for i, w in enumerate(words)}
    return _PLACES[key]
