"""Language identification with a linear-chain CRF (operator 6).

Each word of a text is labelled with a language; neighbouring labels are tied
by learned transitions, so code-switched text is segmented. Word features are
hashed character n-grams of ``^word$`` (those with a marker are affixes) and
one lexicon feature, the word's log odds of every language. Forward-backward
gives each word's label probabilities; a document's language is the one with
the largest share of its words, and that share is the score.

The classifier is fitted on the driver on a bounded sample of training
documents: ``SAMPLE_DOCS`` distinct texts a language with the smallest text
hashes, of ``SAMPLE_CHARS`` code points where there are enough of those. Half of them make the lexicon, the other half are cut into stretches
and strung together into chains that switch language, from which the weights
and transitions are learned. Every document is then scored over its whole text.

Edge cases: a null text, or one without a letter, is ``und`` with score 0.
Words without a letter carry no evidence of their own. If nothing can be
learned (no labelled text) every document is ``und``. Ties go to the language
that sorts first. A null doc_id counts as training if it has a language.
A very long text is labelled whole. Repeated rows get the same label. An empty table gives no rows. Extra columns
are dropped unless named in ``keep``; a result replaces one of its name.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import kept_fields, map_batches

HOLD_OUT = (4, 2)                # crc32(doc_id) mod 4 = 2 is held out
SAMPLE_DOCS = 160                # distinct training texts a language
SAMPLE_CHARS = (40, 8000)        # preferred lengths; such a text is used whole
HASH_BITS = 16                   # n-gram weights: 2^16 a language
GRAMS = (1, 2, 3, 4)
LEXICON_FLOOR = 2                # a word counts in the lexicon from this often on
CHAIN_WORDS, STRETCH_WORDS = 96, (6, 40)
STEPS, RATE, RIDGE = 60, 0.15, 1e-3
CACHE_WORDS = 120_000            # word scores kept in a worker; a full cache starts anew
BLOCK_WORDS = 150_000            # words in one forward-backward block
UNDEFINED = "und"


def held_out(doc_id: Column, modulus: int = HOLD_OUT[0], remainder: int = HOLD_OUT[1]) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


def gram_features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-grams of all words one after another, start of each word's).
    A word without letters has only the number 0."""
    marked = [f"\x02{w}\x03" if has_letter(w) else "" for w in words]
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    room = (ends[owner] if len(owner) else np.zeros(0, dtype=np.int64)) - np.arange(len(codes))     # characters to the word's end
    grams, owners = [np.zeros(len(words), dtype=np.int64)], [np.arange(len(words))]
    value = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        shifted = np.zeros(len(codes), dtype=np.uint64)
        shifted[:len(codes) - n + 1] = codes[n - 1:] if n <= len(codes) else 0
        value = value * np.uint64(1_000_003) + shifted + np.uint64(1)
        if n in GRAMS:
            fits = np.flatnonzero(room >= n)
            mixed = (value[fits] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            grams.append((mixed >> np.uint64(64 - HASH_BITS)).astype(np.int64) + 1)
            owners.append(owner[fits])
    of, gram = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(of, kind="stable")
    return gram[order], np.searchsorted(of[order], np.arange(len(words)))


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray          # (2^HASH_BITS + 1, languages); row 0 is the bias of every word
    lexicon: dict[str, np.ndarray]
    lexicon_weight: float
    transitions: np.ndarray
    start: np.ndarray

    def emissions(self, words: Sequence[str]) -> np.ndarray:
        """Label scores of each word from its own features."""
        grams, starts = gram_features(words)
        out = np.add.reduceat(self.weights[grams], starts, axis=0) if len(words) else np.zeros((0, len(self.languages)))
        counts = np.diff(np.append(starts, len(grams)))
        out = out / np.sqrt(counts)[:, None]
        known = [(i, self.lexicon[w]) for i, w in enumerate(words) if w in self.lexicon]
        if known:
            out[[i for i, _ in known]] += self.lexicon_weight * np.array([v for _, v in known])
        out[counts == 1] = 0.0            # no letter: no evidence
        return out


def forward_backward(emit: np.ndarray, transitions: np.ndarray, start: np.ndarray,
                     length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities (time, chain, label), log partition, and expected
    transitions, for chains sorted by falling length and padded in time.
    Probabilities are scaled at every step."""
    steps, chains, k = emit.shape
    top = emit.max(axis=2, keepdims=True)
    likely = np.exp(emit - top)
    move = np.exp(transitions)
    live = [int(n) for n in (length[None, :] > np.arange(steps)[:, None]).sum(axis=1)]
    alpha = np.zeros((steps, chains, k))
    scale = np.ones((steps, chains))
    for t in range(steps):
        n = live[t]
        a = (np.exp(start) if t == 0 else alpha[t - 1, :n] @ move) * likely[t, :n]
        scale[t, :n] = a.sum(axis=1)
        alpha[t, :n] = a / scale[t, :n, None]
    beta = np.ones((steps, chains, k))
    pairs = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        n = live[t + 1]
        ahead = likely[t + 1, :n] * beta[t + 1, :n] / scale[t + 1, :n, None]
        beta[t, :n] = ahead @ move.T
        pairs += (alpha[t, :n].T @ ahead) * move
    marginal = alpha * beta
    log_z = (np.log(scale) + np.where(np.arange(steps)[:, None] < length[None, :], top[:, :, 0], 0.0)).sum(axis=0)
    return marginal, log_z, pairs


def sample_texts(labelled: DataFrame, docs_per_language: int = SAMPLE_DOCS) -> list[tuple[str, str]]:
    """(lang, text): each language's ``docs_per_language`` distinct texts with
    the smallest hashes, first of those of ``SAMPLE_CHARS`` code points, then,
    where a language has too few of them, of its other texts (of a longer one a
    stretch of that many from its middle, for the fit alone). Hash thresholds
    from the numbers of distinct texts let about twice as many through, so what
    reaches the driver is bounded by languages x 4 ``docs_per_language`` texts
    of bounded length, whatever the size of a language or of a group of copies."""
    least, most = SAMPLE_CHARS
    size = F.length("text")
    stretch = F.substr(F.col("text"), F.greatest(F.floor((size - most) / 2).cast("int") + 1, F.lit(1)), F.lit(most))
    fit = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.when(size.between(least, most), 0).otherwise(1).alias("tier"), F.xxhash64("text").alias("h"), stretch.alias("text"))
    per = fit.groupBy("lang").agg(F.approx_count_distinct(F.when(F.col("tier") == 0, F.col("h"))).alias("own"),
                                  F.approx_count_distinct(F.when(F.col("tier") == 1, F.col("h"))).alias("others"))   # one row a language
    wanted = F.array(F.lit(2.0 * docs_per_language), F.greatest(F.lit(0.0), 2.0 * (docs_per_language - 0.8 * F.col("own"))))
    edges = per.select("lang", F.posexplode(F.arrays_zip(wanted.alias("wanted"), F.array("own", "others").alias("texts"))).alias("tier", "of")) \
        .select("lang", "tier", (F.least(F.lit(1.0), F.col("of.wanted") / F.greatest("of.texts", F.lit(1))) * F.lit(2.0 ** 64)
                                 - F.lit(2.0 ** 63)).alias("edge"), F.col("of.wanted").alias("wanted"))
    rows = fit.join(F.broadcast(edges), ["lang", "tier"]).where((F.col("wanted") > 0) & (F.col("h").cast("double") <= F.col("edge"))) \
        .groupBy("lang", "tier", "h").agg(F.min("text").alias("text")).collect()
    smallest: dict[str, list[tuple[int, int, str]]] = {}
    for r in rows:
        smallest.setdefault(r["lang"], []).append((r["tier"], r["h"], r["text"]))
    return sorted((lang, text) for lang, texts in smallest.items() for _, _, text in sorted(texts)[:docs_per_language])


def words_of(text: str) -> list[str]:
    return text.lower().split()


def fit(sample: list[tuple[str, str]], seed: int = 7) -> Crf | None:
    """Learn the CRF from (language, text) pairs; None without any."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    k, rng = len(languages), np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(languages)}
    halves: list[list[tuple[int, list[str]]]] = [[], []]
    seen = dict.fromkeys(languages, 0)
    for lang, text in sample:
        halves[seen[lang] % 2].append((number[lang], words_of(text)))
        seen[lang] += 1
    if not halves[1]:
        halves[1] = halves[0]
    counts: dict[str, np.ndarray] = {}
    for lang, words in halves[0]:
        for w in words:
            counts.setdefault(w, np.zeros(k))[lang] += 1
    totals = np.maximum(1.0, sum(counts.values(), np.zeros(k)))
    lexicon = {}
    for w, c in counts.items():
        if c.sum() >= LEXICON_FLOOR and has_letter(w):
            share = (c + 0.5) / (totals + 0.5 * k)
            lexicon[w] = np.log(share) - np.log(share).mean()
    chains = _chains(halves[1], rng)
    model = Crf(languages, np.zeros(((1 << HASH_BITS) + 1, k), dtype=np.float64), lexicon, 0.5,
                np.full((k, k), -np.log(k)), np.full(k, -np.log(k)))
    if k > 1 and chains:
        _train(model, chains)
    return model


def _chains(docs: list[tuple[int, list[str]]], rng: np.random.Generator) -> list[tuple[list[str], np.ndarray]]:
    """Stretches of documents in random order, strung into code-switched chains."""
    stretches = []
    for lang, words in docs:
        at = 0
        while at < len(words):
            n = int(rng.integers(*STRETCH_WORDS))
            stretches.append((lang, words[at:at + n]))
            at += n
    chains, words, labels = [], [], []
    for i in rng.permutation(len(stretches)):
        lang, part = stretches[i]
        words, labels = words + part, labels + [lang] * len(part)
        while len(words) >= CHAIN_WORDS:
            chains.append((words[:CHAIN_WORDS], np.array(labels[:CHAIN_WORDS])))
            words, labels = words[CHAIN_WORDS:], labels[CHAIN_WORDS:]
    if words:
        chains.append((words, np.array(labels)))
    return sorted(chains, key=lambda c: -len(c[0]))


def _train(model: Crf, chains: list[tuple[list[str], np.ndarray]]) -> None:
    """Adam on the penalised conditional log likelihood of all chains."""
    k = len(model.languages)
    vocabulary: dict[str, int] = {}
    steps = len(chains[0][0])
    ids = np.zeros((steps, len(chains)), dtype=np.int64)
    gold = np.zeros((steps, len(chains), k))
    length = np.array([len(w) for w, _ in chains])
    inside = np.arange(steps)[:, None] < length[None, :]
    gold_pairs = np.zeros((k, k))
    for c, (words, labels) in enumerate(chains):
        ids[:len(words), c] = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        gold[np.arange(len(words)), c, labels] = 1
        np.add.at(gold_pairs, (labels[:-1], labels[1:]), 1)
    words = list(vocabulary)
    grams, starts = gram_features(words)
    counts = np.diff(np.append(starts, len(grams)))
    norm = 1 / np.sqrt(counts)
    norm[counts == 1] = 0.0
    lex = np.zeros((len(words), k))
    for i, w in enumerate(words):
        if w in model.lexicon:
            lex[i] = model.lexicon[w]
    lex[counts == 1] = 0.0
    owner = np.repeat(np.arange(len(words)), counts)
    params = [model.weights, np.array([model.lexicon_weight]), model.transitions, model.start]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n_words = float(length.sum())
    for step in range(1, STEPS + 1):
        weights, lex_weight, transitions, start = params
        emit = np.add.reduceat(weights[grams], starts, axis=0) * norm[:, None] + lex_weight * lex
        marginal, _, pairs = forward_backward(emit[ids], transitions, start, length)
        wrong = np.where(inside[:, :, None], gold - marginal, 0.0)
        by_word = np.stack([np.bincount(ids.ravel(), wrong[:, :, j].ravel(), len(words)) for j in range(k)], axis=1)
        spread = (by_word * norm[:, None])[owner]
        grad = [np.stack([np.bincount(grams, spread[:, j], len(weights)) for j in range(k)], axis=1),
                np.array([(by_word * lex).sum()]), gold_pairs - pairs, (gold[0] - marginal[0]).sum(axis=0)]
        for i, (p, g) in enumerate(zip(params, grad)):
            g = g / n_words - RIDGE / n_words * p
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            p += RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)
    model.lexicon_weight = float(params[1][0])


class Labeller:
    """Word scores with a bounded cache, and label shares of texts."""

    def __init__(self, model: Crf) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model.languages)))

    def _ids(self, words: list[str]) -> np.ndarray:
        get = self.place.get
        ids = [get(w, -1) for w in words]
        if -1 in ids:
            missing = list(dict.fromkeys(w for w, i in zip(words, ids) if i < 0))
            if len(self.place) + len(missing) > CACHE_WORDS and self.place:
                self._forget()
                return self._ids(words)
            base = len(self.place)
            while base + len(missing) > len(self.table):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.table[base:base + len(missing)] = self.model.emissions(missing)
            self.place.update(zip(missing, range(base, base + len(missing))))
            get = self.place.get
            ids = [get(w) for w in words]
        return np.array(ids, dtype=np.int64)

    def marginals(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Each document's (words, languages) label probabilities."""
        out: list[np.ndarray] = [np.zeros((0, len(self.model.languages)))] * len(docs)
        order = sorted((i for i in range(len(docs)) if docs[i]), key=lambda i: -len(docs[i]))
        at = 0
        while at < len(order):
            steps, take = len(docs[order[at]]), at
            # chains of like length go together: padding stays below a half
            while take < len(order) and (take == at or (2 * len(docs[order[take]]) >= steps and steps * (take + 1 - at) <= BLOCK_WORDS)):
                take += 1
            group = order[at:take]
            length = np.array([len(docs[i]) for i in group])
            flat = self._ids([w for i in group for w in docs[i]])
            emit = np.zeros((steps, len(group), len(self.model.languages)))
            scores, lo = self.table[flat], 0
            for c, n in enumerate(length):
                emit[:n, c] = scores[lo:lo + n]
                lo += n
            marginal, _, _ = forward_backward(emit, self.model.transitions, self.model.start, length)
            for c, i in enumerate(group):
                out[i] = marginal[:length[c], c]
            at = take
        return out


_LABELLERS: dict[str, Labeller] = {}


def _labeller(key: str, model: Crf) -> Labeller:
    if key not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[key] = Labeller(model)
    return _LABELLERS[key]


def identify(docs: DataFrame, model: Crf | None, *, keep: Sequence[str] = ("doc_id",), segments: bool = False) -> DataFrame:
    """The ``keep`` columns with lang_pred and score; with ``segments`` also
    the stretches of words (first word, end word, language) of equal label."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    own, schema = kept_fields(docs, keep, "lang_pred string, score double"
                              + (", segments array<struct<first: int, stop: int, lang: string>>" if segments else ""))

    def run(batches):
        model = shared.value
        for b in batches:
            texts = b["text"] if "text" in own else b.pop("text")
            heard = [t is not None and has_letter(t) and model is not None for t in texts]
            words = [words_of(t) if ok else [] for t, ok in zip(texts, heard)]
            labels, scores, parts = [], [], []
            for w, m in zip(words, _labeller(key, model).marginals(words) if model is not None else [None] * len(words)):
                if not w:
                    labels.append(UNDEFINED)
                    scores.append(0.0)
                    parts.append([])
                    continue
                share = m.mean(axis=0)
                best = int(share.argmax())
                labels.append(model.languages[best])
                scores.append(float(min(1.0, share[best])))
                if segments:
                    label = m.argmax(axis=1)
                    at = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(w)]
                    parts.append([{"first": lo, "stop": hi, "lang": model.languages[label[lo]]} for lo, hi in zip(at, at[1:])])
            yield b | {"lang_pred": labels, "score": scores} | ({"segments": parts} if segments else {})

    return map_batches(docs.select(*own, *([] if "text" in own else ["text"])), run, schema, max_bytes=4 << 20)


def train_and_identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from documents not held out."""
    out = held_out(F.col("doc_id"))
    model = fit(sample_texts(docs.where(~out).select("lang", "text")))
    return identify(docs.withColumn("held_out", out), model, keep=("doc_id", "held_out"))
