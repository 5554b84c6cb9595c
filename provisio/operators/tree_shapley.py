"""Exact Shapley values of boosted trees over a whole population (M-13).

The explained quantity is the model's log-odds, a weighted sum of trees, so its
Shapley values are sums over leaves. A leaf's path asks something of at most
``depth`` players. For one leaf, a row is described by its *pattern*: which of
those players' conditions it fulfils. A coalition S reaches the leaf from an
explained row x and a background row b if x fulfils the conditions of S and b
those of the others. The leaf's game therefore depends on the background only
through the number of its rows with each pattern:

1. One aggregate over the whole population counts patterns, leaf by leaf:
   at most 2^depth numbers a leaf, whatever the number of rows.
2. The driver turns each leaf's counts into a table: pattern of x -> Shapley
   value of each player. Its size depends on the model alone.
3. One narrow pass looks every row's patterns up and adds. No row is paired
   with another, and no coalition is expanded.

Both passes are numpy over Arrow batches. Rows with a missing input count
nowhere and get no values; rows that share a key stay apart, since nothing is
joined. The result equals the coalition form over all population rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

Player = tuple[str, list[str]]      # name, its model columns (the one-hot columns of a category are one player)


@dataclass(frozen=True)
class Leaf:
    value: float                                   # times the tree's weight, in log-odds
    players: tuple[int, ...]                       # whose conditions the path asks
    conditions: tuple[tuple[tuple[int, bool], ...], ...]   # of each: (split, True: its left side)


@dataclass(frozen=True)
class Paths:
    columns: tuple[str, ...]
    players: tuple[str, ...]
    splits: tuple[tuple[int, float, tuple[float, ...] | None], ...]   # column, threshold or left categories
    leaves: tuple[Leaf, ...]

    @property
    def patterns(self) -> int:
        return 1 << max((len(leaf.players) for leaf in self.leaves), default=0)


def paths_of(model, players: Sequence[Player]) -> Paths:
    """The leaves of a fitted ``GBTClassificationModel`` whose features are the
    players' columns in order. Its probability is 1 / (1 + exp(-2 margin)), so
    a leaf counts twice its weighted prediction."""
    columns = [c for _, group in players for c in group]
    owner = [j for j, (_, group) in enumerate(players) for _ in group]
    splits: dict[tuple, int] = {}
    leaves: list[Leaf] = []

    def walk(node, weight: float, path: list[tuple[int, int, bool]]) -> None:
        if not hasattr(node, "split") or node.getClass().getSimpleName() == "LeafNode":
            asked: dict[int, list[tuple[int, bool]]] = {}
            for player, split, left in path:
                asked.setdefault(player, []).append((split, left))
            order = sorted(asked)
            leaves.append(Leaf(2.0 * weight * node.prediction(), tuple(order), tuple(tuple(asked[p]) for p in order)))
            return
        split = node.split()
        column = split.featureIndex()
        if split.getClass().getSimpleName() == "ContinuousSplit":
            key = (column, float(split.threshold()), None)
        else:
            key = (column, 0.0, tuple(split.leftCategories()))
        number = splits.setdefault(key, len(splits))
        walk(node.leftChild(), weight, [*path, (owner[column], number, True)])
        walk(node.rightChild(), weight, [*path, (owner[column], number, False)])

    java = model._java_obj
    for tree, weight in zip(java.trees(), java.treeWeights()):
        walk(tree.rootNode(), float(weight), [])
    return Paths(tuple(columns), tuple(name for name, _ in players), tuple(splits), tuple(leaves))


def _pattern_reader(paths: Paths):
    """rows x columns -> each leaf's pattern of every row, one leaf at a time.
    Self-contained, so that tasks need nothing but numpy."""
    splits, asked = paths.splits, [leaf.conditions for leaf in paths.leaves]

    def read(matrix):
        import numpy as np

        left = [matrix[:, c] <= t if cats is None else np.isin(matrix[:, c], cats) for c, t, cats in splits]
        for conditions in asked:
            code = np.zeros(len(matrix), dtype=np.int64)
            for bit, of_player in enumerate(conditions):
                fulfilled = np.ones(len(matrix), dtype=bool)
                for split, is_left in of_player:
                    fulfilled &= left[split] if is_left else ~left[split]
                code |= fulfilled.astype(np.int64) << bit
            yield code

    return read


def _matrix_reader(columns: Sequence[str]):
    """An Arrow batch -> (rows x columns as doubles, which rows are complete)."""
    names = list(columns)

    def read(batch):
        import numpy as np
        import pyarrow as pa

        found = [batch.column(batch.schema.get_field_index(c)) for c in names]
        complete = np.ones(batch.num_rows, dtype=bool)
        for column in found:
            complete &= np.asarray(column.is_valid())
        doubles = [np.asarray(c.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64) for c in found]
        return np.stack(doubles, axis=1) if doubles else np.zeros((batch.num_rows, 0)), complete

    return read


def pattern_counts(population: DataFrame, paths: Paths) -> tuple[np.ndarray, int]:
    """(leaves x patterns, number of complete rows): how many rows of the whole
    population show each pattern. Tasks count, one aggregate adds up, and the
    driver gets at most one number for each leaf and pattern."""
    patterns, n_leaves = paths.patterns, len(paths.leaves)
    read, load = _pattern_reader(paths), _matrix_reader(paths.columns)

    def count(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((n_leaves, patterns), dtype=np.int64)
        rows = 0
        for batch in batches:
            matrix, complete = load(batch)
            matrix = matrix[complete]
            rows += len(matrix)
            for leaf, code in enumerate(read(matrix)):
                total[leaf] += np.bincount(code, minlength=patterns)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"slot": np.append(at, -1), "n": np.append(total.ravel()[at], rows)})

    slim = population.select(*[F.col(c).cast("double").alias(c) for c in paths.columns])
    counted = slim.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    out, rows = np.zeros(n_leaves * patterns), 0
    for slot, n in counted:
        if slot < 0:
            rows = n
        else:
            out[slot] = n
    return out.reshape(n_leaves, patterns), rows


def _weights(k: int) -> np.ndarray:
    """(k x 2^k): a game's values times this row add up to a player's Shapley value."""
    out = np.zeros((k, 1 << k))
    for j in range(k):
        for s in range(1 << k):
            size = bin(s).count("1")
            if s >> j & 1:
                out[j, s] = factorial(size - 1) * factorial(k - size) / factorial(k)
            else:
                out[j, s] = -factorial(size) * factorial(k - size - 1) / factorial(k)
    return out


def value_tables(paths: Paths, counts: np.ndarray, rows: int) -> tuple[np.ndarray, float]:
    """(leaves x patterns x players, expected log-odds): what each leaf adds to
    each player's Shapley value, by the explained row's pattern."""
    tables = np.zeros((len(paths.leaves), paths.patterns, len(paths.players)))
    expected = 0.0
    weights = {k: _weights(k) for k in {len(leaf.players) for leaf in paths.leaves}}
    for number, leaf in enumerate(paths.leaves):
        k = len(leaf.players)
        share = counts[number, :1 << k] / max(1, rows)
        # background rows that fulfil at least the players of a set: sums over supersets
        at_least = share.copy()
        for bit in range(k):
            low = [s for s in range(1 << k) if not s >> bit & 1]
            at_least[low] += at_least[[s | 1 << bit for s in low]]
        full = (1 << k) - 1
        expected += leaf.value * at_least[full]
        sets = np.arange(1 << k)
        reached = (sets[None, :] & ~sets[:, None]) == 0            # the row's pattern holds the coalition
        game = np.where(reached, leaf.value * at_least[full - sets][None, :], 0.0)
        tables[number, :1 << k, list(leaf.players)] = (game @ weights[k].T).T
    return tables, expected


def _value(group: Sequence[str]) -> Column:
    """A player's value: its column, or the place of the set one-hot column (0: none)."""
    if len(group) == 1:
        return F.col(group[0]).cast("double")
    place = F.lit(0.0)
    for i, c in enumerate(group, start=1):
        place = place + F.col(c) * i
    return place


def shapley_over_population(df: DataFrame, model, players: Sequence[Player], population: DataFrame | None = None, *,
                            out: str = "shapley") -> DataFrame:
    """M-13: every row of ``df`` with the exact Shapley values of the model's
    log-odds against all complete rows of ``population`` (default: ``df``).

    Adds ``out`` (array of feature, feature_pos, value, contribution),
    expected_log_odds and background_rows; a row with a missing input keeps
    NULL contributions."""
    paths = paths_of(model, players)
    counts, rows = pattern_counts(df if population is None else population, paths)
    tables, expected = value_tables(paths, counts, rows)
    shared = df.sparkSession.sparkContext.broadcast(tables)          # its size depends on the model alone
    read, load = _pattern_reader(paths), _matrix_reader([f"_in_{c}" for c in paths.columns])
    k = len(paths.players)

    def explain(batches):
        import numpy as np
        import pyarrow as pa

        tables = shared.value
        for batch in batches:
            matrix, complete = load(batch)
            phi = np.zeros((len(matrix), k))
            for leaf, code in enumerate(read(np.where(complete[:, None], matrix, 0.0))):
                phi += tables[leaf][code]
            values = pa.array(phi.ravel(), mask=np.repeat(~complete, k))
            lists = pa.ListArray.from_arrays(np.arange(0, len(matrix) * k + 1, k, dtype=np.int32), values)
            keep = [batch.column(i) for i, name in enumerate(batch.schema.names) if not name.startswith("_in_")]
            names = [name for name in batch.schema.names if not name.startswith("_in_")]
            yield pa.RecordBatch.from_arrays([*keep, lists], names=[*names, "_phi"])

    inputs = df.select("*", *[F.col(c).cast("double").alias(f"_in_{c}") for c in paths.columns])
    schema = T.StructType([*df.schema.fields, T.StructField("_phi", T.ArrayType(T.DoubleType()))])
    phis = F.array(*[F.struct(F.lit(name).alias("feature"), F.lit(j).alias("feature_pos"), _value(group).alias("value"),
                              F.get("_phi", F.lit(j)).alias("contribution")) for j, (name, group) in enumerate(players)])
    return (inputs.mapInArrow(explain, schema)
            .select(*df.columns, phis.alias(out), F.lit(expected).alias("expected_log_odds"), F.lit(rows).cast("long").alias("background_rows")))
