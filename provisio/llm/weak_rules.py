"""Quality rules as weak supervision (operator 7).

Each rule votes good, bad or abstains on a document's measures. The vote
patterns of all documents are counted (at most 3^rules rows), and
expectation-maximisation over that histogram estimates the share of good
documents and, for each rule, how often its vote is right on good and on bad
documents. A document's posterior probability of being good replaces the
usual "must pass every rule" filter.

Measures are counted in one pass over whole texts; the votes and the
posterior are column expressions. Letters are A-Z, a-z and every code point
beyond ASCII; capitals are A-Z.

Edge cases: a null, empty or blank text has no words, zero counts, and fails
the base rule. A document on which every rule abstains gets the prior.
A very long text is measured whole, as one row of one task. A posterior equal
to ``KEEP_POSTERIOR`` is kept. Repeated rows are judged alike. An empty table gives no rows. Extra columns
are dropped by ``measures`` unless named in ``keep``; a measure replaces one of
its name.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import ASCII_SPACE, fresh, kept_fields, land, map_batches, utf8

SYMBOLS = b"#*$%&|<>"
# Frequent function words of the supported languages.
STOP_WORDS = frozenset(w.encode() for w in (
    "the of and to in is that it for on was with as are be this by or an from "
    "der die das und den in von zu mit sich des auf ist im dem nicht ein eine als auch "
    "le la les de des du et en un une est que qui dans pour au sur pas plus par "
    "el los las del y en que por con para una es se no un su al lo como").split())

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_lines long, n_letters long, n_upper long, n_stop long, n_doubled long, n_bars long")
KEEP_POSTERIOR = 0.5
EM_ROUNDS = 200


def _repeat_words(words: list) -> int:
    """Words inside a three-word window that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    k = len(ids)
    pairs = codes[:-1] * k + codes[1:]
    if k < 1 << 20:
        windows = pairs[:-1] * k + codes[2:]
    else:       # renumber the pairs so that a window's number cannot overflow
        windows = np.unique(pairs, return_inverse=True)[1][:-1].astype(np.int64) * k + codes[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    at = np.concatenate((order[1:][same], order[:-1][same]))
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[at + shift] = True
    return int(covered.sum())


def text_measures(data: bytes) -> tuple[int, ...]:
    """The measures of one UTF-8 text, in the order of ``MEASURES``."""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip(ASCII_SPACE)]
    spaces = sum(data.count(bytes([c])) for c in ASCII_SPACE)
    points = len(data.translate(None, _CONTINUATION))
    n_upper = len(data) - len(data.translate(None, _UPPER))
    n_lower = len(data) - len(data.translate(None, _LOWER))
    beyond = len(data.translate(None, _NOT_LEAD))
    return (len(words), points - spaces, sum(data.count(bytes([c])) for c in SYMBOLS), len(lines) - len(set(lines)),
            _repeat_words(words), len(lines), n_upper + n_lower + beyond, n_upper,
            sum(map(STOP_WORDS.__contains__, data.lower().split())), sum(map(data.count, _DOUBLED)), sum(map(data.count, _BARS)))


# byte classes: A-Z, a-z, UTF-8 continuation bytes, and all but the first bytes of code points beyond ASCII
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_CONTINUATION = bytes(range(128, 192))
_NOT_LEAD = bytes(range(192))
_BARS = (b" | ", " · ".encode(), " • ".encode(), " » ".encode())      # separators of menus and tables
_DOUBLED = tuple(2 * bytes([c]) for c in b"!?#*$%&|<>~^@=")


def measures(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and every measure of the whole text."""
    own, schema = kept_fields(docs, keep, MEASURES)
    (body,) = fresh(docs.select(*own), "measured_text")
    names = [m.split()[0] for m in MEASURES.split(", ")]

    def run(batches):
        for b in batches:
            rows = [text_measures(t) for t in b.pop(body)]
            yield b | dict(zip(names, map(list, zip(*rows)) if rows else [[] for _ in names]))

    return map_batches(docs.select(*own, utf8().alias(body)), run, schema)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rule_votes() -> dict[str, Column]:
    """Rule name -> vote: 1 good, -1 bad, 0 abstains."""
    c = F.col
    share = lambda a, b: c(a) / F.greatest(c(b), F.lit(1))
    word_length, none = share("word_chars", "n_words"), c("n_words") == 0
    return {
        "length": _vote(c("n_words") >= 80, c("n_words") < 50),
        "word_length": _vote(word_length.between(3, 9), none | (word_length < 2.2) | (word_length > 14)),
        "symbols": _vote(share("n_symbols", "n_words") < 0.05, share("n_symbols", "n_words") > 0.25),
        "line_repeats": _vote((c("n_lines") >= 3) & (share("n_dup_lines", "n_lines") < 0.1), share("n_dup_lines", "n_lines") > 0.3),
        "word_repeats": _vote((c("n_words") >= 20) & (share("n_repeat_words", "n_words") < 0.2), share("n_repeat_words", "n_words") > 0.5),
        "capitals": _vote(share("n_upper", "n_letters") < 0.2, share("n_upper", "n_letters") > 0.6),
        "letters": _vote(share("n_letters", "word_chars") > 0.9, share("n_letters", "word_chars") < 0.75),
        "stop_words": _vote(share("n_stop", "n_words") > 0.05, none | ((c("n_words") >= 20) & (share("n_stop", "n_words") < 0.02))),
        "separators": _vote(share("n_bars", "n_words") < 0.01, share("n_bars", "n_words") > 0.15),
        "doubled_marks": _vote(share("n_doubled", "n_words") < 0.01, share("n_doubled", "n_words") > 0.15),
    }


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """EM over a histogram of vote patterns: (share of good documents,
    P(votes good | good), P(votes bad | bad)) with abstentions left out.
    Good votes are right at least half of the time on good documents, and a bad
    vote never speaks for a document: that fixes which class is the good one,
    and lets a rule that says good to everything weigh nothing."""
    n_rules = patterns.shape[1]
    prior, right_good, right_bad = 0.7, np.full(n_rules, 0.8), np.full(n_rules, 0.8)
    good, bad = patterns > 0, patterns < 0
    for _ in range(rounds):
        p = posterior(patterns, prior, right_good, right_bad)
        w_good, w_bad = counts * p, counts * (1 - p)
        prior_new = float(np.clip((w_good.sum() + 1) / (counts.sum() + 2), 0.01, 0.99))
        g = np.clip((w_good @ good + 4) / (w_good @ good + w_good @ bad + 5), 0.5, 0.995)
        b = np.clip((w_bad @ bad + 4) / (w_bad @ bad + w_bad @ good + 5), 1 - g, 0.995)
        moved = max(abs(prior - prior_new), np.abs(g - right_good).max(initial=0), np.abs(b - right_bad).max(initial=0))
        prior, right_good, right_bad = prior_new, g, b
        if moved < 1e-9:
            break
    return prior, right_good, right_bad


def vote_weights(prior: float, right_good: np.ndarray, right_bad: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log odds of the prior, of a good vote and of a bad vote."""
    return (float(np.log(prior / (1 - prior))), np.log(right_good / (1 - right_bad)), np.log((1 - right_good) / right_bad))


def posterior(patterns: np.ndarray, prior: float, right_good: np.ndarray, right_bad: np.ndarray) -> np.ndarray:
    base, up, down = vote_weights(prior, right_good, right_bad)
    return 1 / (1 + np.exp(-(base + (patterns > 0) @ up + (patterns < 0) @ down)))


def judge(measured: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Add base_failed, posterior and kept to a frame of measures. The frame
    is read twice, so pass a written one."""
    rules = rules or rule_votes()
    voted = measured.withColumn("votes", F.array(*rules.values()))
    rows = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()     # at most 3^rules rows
    patterns = np.array([r["votes"] for r in rows], dtype=np.int64).reshape(len(rows), len(rules))
    base, up, down = vote_weights(*fit_votes(patterns, np.array([r["n"] for r in rows], dtype=np.float64)))
    odds = F.lit(base)
    for i, (u, d) in enumerate(zip(up.tolist(), down.tolist())):
        vote = F.col("votes")[i]
        odds = odds + F.when(vote > 0, u).when(vote < 0, d).otherwise(0.0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (voted.withColumn("base_failed", failed)
            .withColumn("posterior", 1 / (1 + F.exp(-odds)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_POSTERIOR)))


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the contract's measures, base_failed, kept, posterior, votes."""
    measured = land(measures(docs), "measures")
    return judge(measured).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                  "base_failed", "kept", "posterior", "votes")
