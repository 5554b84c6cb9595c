"""Attributions and the per-company credit memo (M-12, M-13, W-3, J-6,
K-5, P-27, F-6 … F-9, R-6 … R-9, R-16).

Attributions are built inside each company's row as an array of
``struct(feature, feature_pos, value, contribution)``; ranking, rule
matching and text assembly are higher-order array expressions on that row.
Nothing is shuffled: the work is one narrow pass over the companies.
"""

from __future__ import annotations

from itertools import combinations
from math import factorial

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import col_, sigmoid
from ..functions.text import display_feature_name, fill_text, fmt_fixed, fmt_pct1, fmt_pct2
from ..sources.tables import sample_n
from .score import SME_INDUSTRIES, SME_NUMERIC, SME_PD_COEF, sme_logit_fixed
from .stress import HIGH_PD

# Model features in design-matrix order: numeric pass-through, then one-hot.
SME_FEATURES = SME_NUMERIC + [f"industry_{c}" for c in SME_INDUSTRIES]
LINEAR_COEF = {**{k: SME_PD_COEF[k] for k in SME_NUMERIC}, **{f"industry_{c}": 0.0 for c in SME_INDUSTRIES}}

# ---- fixed values: business insight rules, in matching order ----
# key, name, threshold, risk test, value format, why-risk text, why-safe text
# (%s: the formatted value), benchmark
INSIGHT_RULES = [
    ("cash_flow_volatility", "Cash Flow Volatility", 1.5, "above", "fixed2",
     "High volatility (%sx) signals instability in operating cash flows.",
     "Cash flow volatility (%sx) is healthy, indicating stable working capital.",
     "Benchmark: <1.5x"),
    ("debt_to_asset_ratio", "Debt-to-Asset Ratio", 0.60, "above", "pct1",
     "Elevated leverage (%s) implies limited buffer against asset devaluation.",
     "Leverage (%s) is conservative with strong equity buffer.",
     "Threshold: 60%"),
    ("revenue_growth", "Revenue Growth", 0.0, "below", "pct1",
     "Negative growth (%s) indicates structural market share loss.",
     "Positive growth (%s) demonstrates market competitiveness.",
     "Sector Avg: 5-10%"),
    ("past_default", "Historical Default", 0.5, "above", "none",
     "Critical Red Flag: Prior credit events detected.",
     "Clean credit history (No prior defaults).",
     "Hard Stop"),
]
RISK_LABEL, SAFE_LABEL = "⚠️ Risk", "✅ Safe"
UP_ARROW, DOWN_ARROW = "▲", "▼"
RISK_COLOUR, SAFE_COLOUR = "#d32f2f", "#388e3c"     # chart bar colours by sign
HIGH_RISK, LOW_RISK = "HIGH RISK", "LOW RISK"
AI_SUGGESTION = "AI Suggestion: Validate flagged metrics against audited financial statements."
NOT_FOUND, FOUND = "NOT_FOUND", "FOUND"
# ---- fixed values: demo allow-list whose PD is overridden into [0.01, 0.04) ----
VIP_IDS = ["HK_00000", "HK_00001", "HK_00002", "HK_00003", "HK_00004", "HK_00005"]
VIP_PD_RANGE = (0.01, 0.04)
TOP_FACTORS = 3
CHART_FACTORS = 6


# ------------------------------------------------------------------ P-27
def hashed_uniform(key: str | Column, lo: float, hi: float) -> Column:
    """A value in [lo, hi) derived from md5(key) — reproducible stand-in for a random draw."""
    u = F.conv(F.substr(F.md5(col_(key).cast("string")), F.lit(1), F.lit(8)), 16, 10).cast("long") / 4294967296.0
    return F.lit(lo) + F.lit(round(hi - lo, 12)) * u


def override(df: DataFrame, key: str, ids: DataFrame, column: str, value: Column) -> DataFrame:
    """P-27: replace ``column`` with ``value`` on rows whose key is in ``ids``
    (an allow-list, broadcast behind a size check; left join keeps every row)."""
    from .sizing import checked_broadcast

    hits = ids.select(F.col(ids.columns[0]).alias("_ovr_key")).distinct().withColumn("_ovr_hit", F.lit(True))
    j = df.join(checked_broadcast(hits), F.col(key) == F.col("_ovr_key"), "left")
    return j.withColumn(column, F.when(F.col("_ovr_hit"), value).otherwise(F.col(column))) \
        .drop("_ovr_key", "_ovr_hit")


def vip_ids(spark) -> DataFrame:
    return spark.createDataFrame([(i,) for i in VIP_IDS], "company_id string")


# ------------------------------------------------------------------ M-12
def feature_means(df: DataFrame, features: list[str]) -> dict[str, float]:
    """Population means of the model features: one global aggregate, one row to the driver."""
    row = df.agg(*[F.avg(f).alias(f) for f in features]).first()
    return {f: float(row[f]) if row[f] is not None else 0.0 for f in features}


def linear_attributions(df: DataFrame, means: dict[str, float], *, out: str = "attributions") -> DataFrame:
    """M-12: log-odds attribution β_j·(x_j − mean_j) of the fixed-coefficient
    SME model, as an array of structs in feature order."""
    items = [F.struct(F.lit(f).alias("feature"), F.lit(pos).alias("feature_pos"),
                      F.col(f).cast("double").alias("value"),
                      ((F.lit(LINEAR_COEF[f]) * (F.col(f) - F.lit(means[f]))) if LINEAR_COEF[f] != 0
                       else F.lit(0.0)).alias("contribution"))
             for pos, f in enumerate(SME_FEATURES)]
    return df.withColumn(out, F.array(*items))


def explode_attributions(df: DataFrame, arr: str = "attributions", keep: tuple[str, ...] = ("company_id",)) -> DataFrame:
    """Long form ``(company_id, feature, feature_pos, value, contribution)``."""
    return df.select(*keep, F.explode(arr).alias("_a")).select(*keep, "_a.*")


# ------------------------------------------------------------------ M-13
def shapley_weights(k: int) -> dict[int, float]:
    """|S|!(k−|S|−1)!/k! for a coalition S without the player."""
    return {s: factorial(s) * factorial(k - s - 1) / factorial(k) for s in range(k)}


MAX_BACKGROUND_ROWS = 10_000    # background rows travel through the driver into the plan


def _checked_background(n: int) -> int:
    if n > MAX_BACKGROUND_ROWS:
        raise ValueError(f"{n} background rows are over {MAX_BACKGROUND_ROWS}; "
                         "tree_shapley.shapley_over_population takes every row as background")
    return n


def background_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> list:
    """Seeded background rows: the ``n`` first complete rows in md5 order.
    ``n`` is the caller's choice of precision, at most ``MAX_BACKGROUND_ROWS``
    (more raise a ValueError); the rows travel as literals."""
    complete = df.select(key, *SME_NUMERIC).dropna(subset=SME_NUMERIC)
    return [tuple(float(r[f]) for f in SME_NUMERIC) for r in sample_n(complete, key, _checked_background(n), seed).collect()]


def _numbered(df: DataFrame, cols: list[str]) -> DataFrame:
    """``df``'s slim columns written once with a row number ``_row``, so that
    rows sharing a key stay apart and a rerun task sees the same numbers."""
    from ..sources.tables import land

    slim = df.select(*cols).withColumn("_row", F.monotonically_increasing_id())
    return df.sparkSession.read.parquet(land(slim, name="explained"))


def shapley_attributions(df: DataFrame, background: list, *, key: str = "company_id", out: str = "shapley",
                         num_partitions: int | None = None) -> DataFrame:
    """M-13: exact Shapley values of the fixed-coefficient SME PD (probability
    scale) over background rows, players = the four numeric features.

    Each entity row is paired with every background row by exploding a
    literal array (narrow, no join); one code-generated projection evaluates
    f(x_S, b_rest) for all 2^k coalitions; a grouped average (partial
    aggregation first, every group has exactly len(background) rows) gives
    v(S); then φ_j = Σ_{S∌j} w(|S|)·(v(S∪{j}) − v(S)). Returns
    ``key, <out> array<struct<feature, feature_pos, value, contribution>>,
    expected_pd, background_rows``. A row with a NULL feature keeps its row
    with NULL contributions. Repeated keys keep one result each.
    """
    return _shapley_of_numbered(_numbered(df, [key, *SME_NUMERIC]), background, key, out, num_partitions)


def shapley_against_sample(df: DataFrame, n: int, *, key: str = "company_id", seed: int = 42, out: str = "shapley",
                           num_partitions: int | None = None) -> DataFrame:
    """:func:`shapley_attributions` against ``background_sample(df, key, n, seed)``.
    ``df`` is computed once: its slim columns are written, and both the
    background and the explained rows are read from there."""
    _checked_background(n)
    numbered = _numbered(df, [key, *SME_NUMERIC])
    return _shapley_of_numbered(numbered, background_sample(numbered, key, n, seed), key, out, num_partitions)


def _shapley_of_numbered(numbered: DataFrame, background: list, key: str, out: str, num_partitions: int | None) -> DataFrame:
    from .stress import spread_for_expansion

    k = len(SME_NUMERIC)
    bg = F.array(*[F.struct(*[F.lit(v).alias(f"b{j}") for j, v in enumerate(row)]) for row in background])
    base = spread_for_expansion(numbered, num_partitions)
    paired = base.select(key, "_row", *[F.col(c).cast("double").alias(c) for c in SME_NUMERIC], F.explode(bg).alias("_b"))

    def f_of(mask: int) -> Column:
        z = [F.col(SME_NUMERIC[j]) if mask >> j & 1 else F.col(f"_b.b{j}") for j in range(k)]
        return sigmoid(sme_logit_fixed(*z))

    vcols = {m: f"_v{m}" for m in range(2 ** k)}
    values = paired.select(key, "_row", *SME_NUMERIC, *[f_of(m).alias(vcols[m]) for m in range(2 ** k)])
    v = values.groupBy(key, "_row", *SME_NUMERIC).agg(*[F.avg(c).alias(c) for c in vcols.values()])
    w = shapley_weights(k)
    phis = []
    for j, f in enumerate(SME_NUMERIC):
        others = [i for i in range(k) if i != j]
        phi = None
        for size in range(k):
            for combo in combinations(others, size):
                mask = sum(1 << i for i in combo)
                term = F.lit(w[size]) * (F.col(vcols[mask | 1 << j]) - F.col(vcols[mask]))
                phi = term if phi is None else phi + term
        complete = F.lit(True)
        for c in SME_NUMERIC:
            complete = complete & F.col(c).isNotNull()
        phis.append(F.struct(F.lit(f).alias("feature"), F.lit(j).alias("feature_pos"), F.col(f).alias("value"),
                             F.when(complete, phi).alias("contribution")))
    return v.select(key, F.array(*phis).alias(out), F.col(vcols[0]).alias("expected_pd"),
                    F.lit(len(background)).alias("background_rows"))


# ------------------------------------------------------------------ W-3 / K-5
def _by_abs_desc(a: Column, b: Column) -> Column:
    aa, bb = F.abs(a["contribution"]), F.abs(b["contribution"])
    return (F.when(aa > bb, -1).when(aa < bb, 1)
            .when(a["feature_pos"] < b["feature_pos"], -1).when(a["feature_pos"] > b["feature_pos"], 1).otherwise(0))


def _by_value_desc(a: Column, b: Column) -> Column:
    return (F.when(a["contribution"] > b["contribution"], -1).when(a["contribution"] < b["contribution"], 1)
            .when(a["feature_pos"] > b["feature_pos"], -1).when(a["feature_pos"] < b["feature_pos"], 1).otherwise(0))


def top_by_magnitude(arr: str | Column, k: int = TOP_FACTORS) -> Column:
    """W-3: the k entries with the largest |contribution| (stable: feature order breaks ties)."""
    return F.slice(F.array_sort(col_(arr), _by_abs_desc), 1, k)


def largest_signed(arr: str | Column, k: int = CHART_FACTORS) -> Column:
    """K-5: the k largest signed contributions, listed ascending (sort
    ascending, keep the last k; equal values keep feature order)."""
    top = F.slice(F.array_sort(col_(arr), _by_value_desc), 1, k)
    return F.reverse(top)


# ------------------------------------------------------------------ J-6 / R-7 / R-8
def _rule_index(feature: Column) -> Column:
    """J-6 + F-9: index (1-based, rule order) of the first rule whose key is
    contained in the feature name; NULL when none matches."""
    expr = None
    for i, rule in enumerate(INSIGHT_RULES, start=1):
        cond = feature.contains(rule[0])
        expr = F.when(cond, i) if expr is None else expr.when(cond, i)
    return expr


def _rule_attr(idx: Column, pos: int) -> Column:
    """Attribute ``pos`` of the rule at ``idx`` (NULL when no rule). A CASE
    chain, not ``element_at``: with ANSI on, ``element_at`` with a NULL index
    is typed non-nullable although it yields NULL."""
    return _pick(idx, [F.lit(r[pos]) for r in INSIGHT_RULES])


def _rule_text(idx: Column, pos: int, value: Column) -> Column:
    """Text ``pos`` of the rule at ``idx`` with the value in its rule's format."""
    shown = {"fixed2": fmt_fixed(value, 2), "pct1": fmt_pct1(value)}
    return _pick(idx, [fill_text(r[pos], shown[r[4]]) if r[4] in shown else F.lit(r[pos]) for r in INSIGHT_RULES])


def _pick(idx: Column, values: list[Column]) -> Column:
    expr = None
    for i, v in enumerate(values, start=1):
        expr = F.when(idx == i, v) if expr is None else expr.when(idx == i, v)
    return expr


def factor_row(x: Column, rank: Column | None = None) -> Column:
    """R-7/R-8 for one attribution struct → struct with insight name, arrow
    text, value text, Risk/Safe and commentary (NULL insight when no rule)."""
    idx = _rule_index(x["feature"])
    val = x["value"]
    threshold = _rule_attr(idx, 2)
    risky = F.when(_rule_attr(idx, 3) == "below", val < threshold).otherwise(val > threshold)
    val_text = F.when(x["feature"].contains("growth") | x["feature"].contains("ratio"), fmt_pct1(val)) \
        .otherwise(fmt_fixed(val, 2))
    risk_text, safe_text = _rule_text(idx, 5, val), _rule_text(idx, 6, val)
    c = x["contribution"]
    return F.struct(
        (rank if rank is not None else F.lit(None).cast("int")).alias("factor_rank"),
        x["feature"].alias("feature"),
        x["feature_pos"].alias("feature_pos"),
        c.alias("contribution"),
        _rule_attr(idx, 1).alias("insight"),
        F.concat(F.when(c > 0, UP_ARROW).otherwise(DOWN_ARROW), F.lit(" "), fmt_fixed(c, 3)).alias("attribution_text"),
        val_text.alias("value_text"),
        F.when(risky, RISK_LABEL).otherwise(SAFE_LABEL).alias("status"),
        F.when(risky, risk_text).otherwise(safe_text).alias("commentary"),
        _rule_attr(idx, 7).alias("benchmark"),
    )


def factor_table(arr: str | Column, k: int = TOP_FACTORS) -> Column:
    """R-7: top-k factors by |contribution| with their insight rows; factors
    without a rule are dropped after the top-k cut."""
    rows = F.transform(top_by_magnitude(arr, k), lambda x, i: factor_row(x, i + 1))
    return F.filter(rows, lambda r: r["insight"].isNotNull())


def risk_level(pd: str | Column) -> Column:
    """R-6: base PD above 0.2 → HIGH RISK else LOW RISK."""
    return F.when(col_(pd) > HIGH_PD, HIGH_RISK).otherwise(LOW_RISK)


def memo_text(pd: Column, factors: Column, header: Column, addendum: Column) -> Column:
    """R-9: plain-text credit memo (header, PD, factor rows, suggestion,
    stress addendum)."""
    lines = F.transform(factors, lambda r: F.concat_ws(" | ", r["insight"], r["attribution_text"],
                                                       F.concat_ws(" ", r["value_text"], r["status"]),
                                                       r["commentary"]))
    return F.concat_ws("\n",
                       header,
                       F.concat(F.lit("EXECUTIVE SUMMARY: "), risk_level(pd)),
                       F.concat(F.lit("Model Prediction (PD): "), fmt_pct2(pd)),
                       F.lit("Risk Factor | AI Attribution | Metric Analysis | Commentary"),
                       F.array_join(lines, "\n"),
                       F.lit(AI_SUGGESTION),
                       addendum)


def chart_rows(arr: str | Column, k: int = CHART_FACTORS) -> Column:
    """R-16: attribution chart data — k largest signed contributions,
    ascending, display names, colour by sign."""
    return F.transform(largest_signed(arr, k), lambda x: F.struct(
        display_feature_name(x["feature"]).alias("feature"),
        x["contribution"].alias("contribution"),
        F.when(x["contribution"] > 0, RISK_COLOUR).otherwise(SAFE_COLOUR).alias("colour")))


# ------------------------------------------------------------------ F-6 / F-7
def lookup(requests: DataFrame, scored: DataFrame, key: str = "company_id") -> DataFrame:
    """F-6: look requested ids up; an unknown id yields status NOT_FOUND
    (never another entity's row)."""
    hit = scored.withColumn("_found", F.lit(True))
    j = requests.join(hit, key, "left")
    return j.withColumn("lookup_status", F.when(F.col("_found"), FOUND).otherwise(NOT_FOUND)).drop("_found")


def members(df: DataFrame, ids: DataFrame, key: str = "company_id") -> DataFrame:
    """F-7: rows whose key is in an id list — left-semi join, with the list
    broadcast when its size check passes (else a shuffle join)."""
    from .sizing import checked_broadcast

    return df.join(checked_broadcast(ids.select(key).distinct()), key, "left_semi")


# ------------------------------------------------------------------ M-13 (any Spark ML model)
def _thresholds(model, players: list[tuple[str, list[str]]]) -> dict[str, list[float]]:
    """The thresholds a model of boosted trees compares each column with,
    ascending; a column that is missing here must keep its values (one split
    by categories, or any other model)."""
    from pyspark.ml.classification import GBTClassificationModel

    from .tree_shapley import paths_of

    if not isinstance(model, GBTClassificationModel):
        return {}
    cols = [c for _, group in players for c in group]
    cuts: dict[str, set[float]] = {c: set() for c in cols}
    splits = paths_of(model, players).splits
    for column, threshold, categories in splits:
        if categories is None:
            cuts[cols[column]].add(threshold)
    for column, _, categories in splits:
        if categories is not None:
            cuts.pop(cols[column], None)
    return {c: sorted(found) for c, found in cuts.items()}


def _cell(x: Column, cuts: list[float] | None, above: float = float("inf")) -> Column:
    """The smallest threshold that is not below ``x`` (infinity above them
    all): it lies on the same side of every threshold as ``x``. A balanced
    CASE tree; without thresholds, ``x`` itself."""
    if cuts is None:
        return x
    if not cuts:
        return F.lit(above)
    m = len(cuts) // 2
    return F.when(x <= F.lit(cuts[m]), _cell(x, cuts[:m], cuts[m])).otherwise(_cell(x, cuts[m + 1:], above))


def shapley_for_model(df: DataFrame, model, players: list[tuple[str, list[str]]], background: list[dict], *,
                      key: str = "company_id", num_partitions: int | None = None) -> DataFrame:
    """M-13 for a trained Spark ML classifier: exact Shapley values of its
    probability, players = groups of model columns (one-hot columns of one
    category form one player).

    φ_j = Σ_S c_j(S)·v(x_S), with c_j(S) = w(|S|−1) when j ∈ S and −w(|S|)
    otherwise, and v(x_S) the mean of f(x_S, b_rest) over the background. v is
    computed once for every coalition and *distinct* x_S, over the distinct
    b_rest with their counts, in one ``model.transform`` pass. A model of trees
    sees only which side of its thresholds a value lies on, so values between
    the same two thresholds count as one there: the scored rows are bounded by
    the thresholds, not by the number of rows (:func:`_cell`). For any other
    model a value stands for itself. Equal rows are explained together and the
    result joined back. It has the attribution shape of M-12 (with values) and
    the background's size; a row with a NULL feature keeps NULL contributions,
    repeated keys stay apart.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from ..sources.tables import land
    from .sizing import checked_broadcast
    from .stress import spread_for_expansion

    spark = df.sparkSession
    k = len(players)
    cols = [c for _, group in players for c in group]
    owner = {c: j for j, (_, group) in enumerate(players) for c in group}
    nb = float(len(background))
    numbered = _numbered(df, [key, *cols])
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    cuts = _thresholds(model, players)

    def cells() -> list[Column]:
        return [F.when(complete, _cell(F.col(c).cast("double"), cuts.get(c))).alias(f"_c_{c}") for c in cols]

    def of_coalitions(frame: DataFrame, inside: bool) -> DataFrame:
        """Every coalition's part of each row (or the others' part); NULL elsewhere."""
        masked = frame.select("*", F.explode(F.sequence(F.lit(0), F.lit(2 ** k - 1))).alias("_mask"))
        member = lambda c: (F.col("_mask").bitwiseAND(F.lit(1 << owner[c])) != 0) == F.lit(inside)
        return masked.select("_mask", *[n for n in frame.columns if n == "_cell"], *[F.when(member(c), F.col(f"_c_{c}")).alias(f"_c_{c}") for c in cols])

    parts = ["_mask", *[f"_c_{c}" for c in cols]]
    distinct = numbered.where(complete).select(*cells()).distinct().withColumn("_cell", F.monotonically_increasing_id())
    # written: both uses below must see the same numbers
    asked = of_coalitions(spread_for_expansion(spark.read.parquet(land(distinct, name="cells")), num_partitions), True)
    bg = spark.createDataFrame([tuple(float(row[c]) for c in cols) for row in background], ", ".join(f"`{c}` double" for c in cols))
    others = of_coalitions(bg.select(*cells()), False).groupBy(*parts).agg(F.count(F.lit(1)).alias("_n")) \
        .select("_mask", "_n", *[F.col(f"_c_{c}").alias(f"_b_{c}") for c in cols])       # at most 2^k rows a background row
    mixed = spread_for_expansion(asked.select(*parts).distinct(), num_partitions).join(F.broadcast(others), "_mask") \
        .select(*parts, "_n", *[F.coalesce(f"_c_{c}", f"_b_{c}").alias(f"_x_{c}") for c in cols])
    assembled = VectorAssembler(inputCols=[f"_x_{c}" for c in cols], outputCol="_features").transform(mixed)
    scored = model.setFeaturesCol("_features").transform(assembled).select(*parts, "_n", vector_to_array(F.col("probability"))[1].alias("_f"))
    v = checked_broadcast(scored.groupBy(*parts).agg((F.sum(F.col("_f") * F.col("_n")) / nb).alias("_v"))
                          .select("_v", *[F.col(p).alias(f"_v{p}") for p in parts]))
    w = shapley_weights(k)

    def coef(j: int) -> Column:
        vals = [w[bin(m).count("1") - 1] if m >> j & 1 else -w[bin(m).count("1")] for m in range(2 ** k)]
        return F.element_at(F.array(*[F.lit(v) for v in vals]), F.col("_mask") + 1)

    same = F.col("_mask") == F.col("_v_mask")
    for p in parts[1:]:
        same = same & F.col(p).eqNullSafe(F.col(f"_v{p}"))
    agg = asked.join(v, same).groupBy("_cell").agg(
        *[F.sum(F.col("_v") * coef(j)).alias(f"_phi{j}") for j in range(k)],
        F.sum(F.when(F.col("_mask") == 0, F.col("_v"))).alias("expected_pd"),
        *[F.max(p).alias(p) for p in parts[1:]])                 # one value each, that of the coalitions holding it

    def value(group: list[str]) -> Column:
        """A player's value: its column, or the place of the set one-hot column (0: none)."""
        if len(group) == 1:
            return F.col(group[0]).cast("double")
        place = F.lit(0.0)
        for i, c in enumerate(group, start=1):
            place = place + F.col(c) * i
        return place

    phis = F.array(*[F.struct(F.lit(name).alias("feature"), F.lit(j).alias("feature_pos"), value(group).alias("value"),
                              F.col(f"_phi{j}").alias("contribution")) for j, (name, group) in enumerate(players)])
    return numbered.select("*", *cells()).join(agg, parts[1:], "left").select(key, phis.alias("shapley"), "expected_pd",
                                                     F.lit(len(background)).alias("background_rows"))


SME_PLAYERS = [(f, [f]) for f in SME_NUMERIC] + [("industry", [f"industry_{c}" for c in SME_INDUSTRIES])]


def model_background(frame: DataFrame, key: str, n: int, seed: int = 42) -> list[dict]:
    """Seeded background rows of the model columns: the ``n`` first complete
    ones, at most ``MAX_BACKGROUND_ROWS``."""
    cols = [c for _, group in SME_PLAYERS for c in group]
    return [r.asDict() for r in sample_n(frame.select(key, *cols).dropna(subset=cols), key, _checked_background(n), seed).collect()]


def insight_rules_frame(spark) -> DataFrame:
    """S-5: the insight rules as a small dimension frame built from the
    literal table above (one row per rule, in rule order)."""
    rows = [(i, r[0], r[1], float(r[2]), r[3], r[7]) for i, r in enumerate(INSIGHT_RULES, start=1)]
    return spark.createDataFrame(rows, "rule_order int, key string, name string, threshold double, "
                                       "direction string, benchmark string")
