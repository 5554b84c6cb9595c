"""Rules as data (J-6, F-9): the first rule, in rule order, whose key a text
contains, for rule tables of any size.

A multi-pattern automaton over the rule keys reads every text once, whatever
the number of rules. Only distinct texts are matched. Rules are taken in
blocks of ``BLOCK_RULES`` by rule order, each an automaton of bounded size that
is broadcast; a table of more rules takes a pass a block, and the smallest rule
order of all passes wins, so no rule is left out.

An empty key is contained in every text, a NULL key in none; a NULL text
matches no rule. Of rules with the same order the smaller key wins.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, functions as F

BLOCK_RULES = 100_000


class Automaton:
    """Aho-Corasick over code points; every state knows the best rule (smallest
    number) among the keys that end there."""

    def __init__(self, keys: list[str], numbers: list[int]) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.best: list[int | None] = [None]
        for key, number in zip(keys, numbers):
            state = 0
            for ch in key:
                following = self.next[state].get(ch)
                if following is None:
                    following = len(self.next)
                    self.next[state][ch] = following
                    self.next.append({})
                    self.best.append(None)
                state = following
            if self.best[state] is None or number < self.best[state]:
                self.best[state] = number
        self.fail = [0] * len(self.next)
        queue = deque(self.next[0].values())
        while queue:
            state = queue.popleft()
            for ch, following in self.next[state].items():
                queue.append(following)
                back = self.fail[state]
                while back and ch not in self.next[back]:
                    back = self.fail[back]
                self.fail[following] = self.next[back].get(ch, 0)
                inherited = self.best[self.fail[following]]
                if inherited is not None and (self.best[following] is None or inherited < self.best[following]):
                    self.best[following] = inherited

    def first(self, text: str) -> int | None:
        """The smallest number of a key inside the text."""
        state, best = 0, self.best[0]
        for ch in text:
            while state and ch not in self.next[state]:
                state = self.fail[state]
            state = self.next[state].get(ch, 0)
            found = self.best[state]
            if found is not None and (best is None or found < best):
                best = found
        return best


def first_rule(df: DataFrame, text: str, rules: DataFrame, *, key: str = "key", order: str = "rule_order",
               out: str = "rule_order", block: int = BLOCK_RULES) -> DataFrame:
    """``df`` with ``out``: the order number of the first rule whose key is
    contained in ``text``, NULL if none is."""
    from .ordered import row_number_global

    spark = df.sparkSession
    usable = rules.where(F.col(key).isNotNull() & F.col(order).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.min(F.col(order).cast("long")).alias("_no"))
    blocks = max(1, -(-usable.count() // block))
    numbered = row_number_global(usable, ["_no", "_key"], out="_rn")
    texts = df.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    found = None
    for b in range(blocks):
        rows = numbered.where((F.col("_rn") > b * block) & (F.col("_rn") <= (b + 1) * block)).select("_key", "_no").collect()   # at most ``block``
        shared = spark.sparkContext.broadcast(([r["_key"] for r in rows], [r["_no"] for r in rows]))
        part = _matched(texts, shared)
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = found.groupBy("_text").agg(F.min("_no").alias("_no"))
    return df.join(found, F.col(text) == F.col("_text"), "left").select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.col("_no").alias(out))


def _matched(texts: DataFrame, shared) -> DataFrame:
    build = Automaton

    def run(batches):
        import pyarrow as pa

        automaton = build(*shared.value)
        for batch in batches:
            own = batch.column(0).to_pylist()
            numbers = [automaton.first(t) for t in own]
            kept = [i for i, n in enumerate(numbers) if n is not None]
            yield pa.RecordBatch.from_pydict({"_text": pa.array([own[i] for i in kept], type=pa.string()),
                                              "_no": pa.array([numbers[i] for i in kept], type=pa.int64())})

    return texts.mapInArrow(run, "_text string, _no long")
