"""DuckDB recomputes what is reported about trained models from their written scores."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE
from provisio.operators import backtest, evaluate, features as feat, score
from provisio.plans import models
from provisio.queries import q_extensions
from provisio.sources.tables import land

AUC = """
with g as (select {by} s, sum(y) as p, count(*) - sum(y) as n from t where s is not null group by {by} s),
c as (select *, sum(n) over ({part} order by s rows between unbounded preceding and current row) - n as below from g)
select {by} sum(p * (below + n * 0.5e0)) / (sum(p) * sum(n)) as auc from c {group}
"""
REPORT = """
select {by} coalesce(count_if(y = 1 and yhat = 1)::double / nullif(count_if(yhat = 1), 0), 0) as precision,
       coalesce(count_if(y = 1 and yhat = 1)::double / nullif(count_if(y = 1), 0), 0) as recall, avg((y = yhat)::int) as accuracy, count_if(y = 1) as support
from t {group}
"""


def duck(path, columns, sql):
    con = duckdb.connect()
    con.execute(f"create view t as select {columns} from '{path.removeprefix('file:')}/*.parquet'")
    return con.execute(sql).fetchall()


def test_logistic_auc_confusion_and_report(spark):
    path = land(models.evaluation_by_model_b(spark, SF_SMOKE))
    rows = spark.read.parquet(path)
    assert evaluate.auc(rows, "s", "y").first()[0] == pytest.approx(duck(path, "*", AUC.format(by="", part="", group=""))[0][0], abs=1e-12)
    cells = sorted(tuple(r) for r in evaluate.confusion_counts(rows, "y", "yhat").collect())
    assert cells == sorted(duck(path, "*", "select y, yhat, count(*) from t group by 1, 2"))
    assert duck(path, "*", "select count(*) from t where yhat <> (s > 0.5)::int")[0][0] == 0
    report = {r["class"]: r for r in evaluate.classification_report(rows, "y", "yhat").collect()}
    precision, recall, accuracy, support = duck(path, "*", REPORT.format(by="", group=""))[0]
    assert (report["Default"].precision, report["Default"].recall, report["accuracy"].f1_score) == pytest.approx((precision, recall, accuracy), abs=1e-12)
    assert report["Default"].support == support


def test_trees_rank_better_than_a_constant(spark):
    model, split = models.gbt_sme(spark, SF_SMOKE, trees=20)
    path = land(score.score_with_model(model, split, score.SME_MODEL_FEATURES, out="s").select(F.col("true_label").alias("y"), "s", "is_test"))
    got = duck(path, "*", AUC.format(by="", part="", group=""))[0][0]
    assert got > 0.7 and got == pytest.approx(evaluate.auc(spark.read.parquet(path), "s", "y").first()[0], abs=1e-12)


def test_rolling_backtest(spark):
    scored, df, cuts, beta = q_extensions.rolling_scores(spark, SF_SMOKE)
    path, columns = land(scored), "cut, default_flag as y, pd as s, yhat"
    want = dict(duck(path, columns, AUC.format(by="cut,", part="partition by cut", group="group by cut")))
    got = {r["cut"]: r["auc"] for r in backtest.auc_by(scored, "cut", "pd", "default_flag").collect()}
    assert got.keys() == want.keys() == set(cuts) and all(got[c] == pytest.approx(want[c], abs=1e-12) for c in cuts if want[c] is not None)
    report = {r["cut"]: r for r in backtest.report_by(scored, "cut", "default_flag", "yhat").collect()}
    for cut, precision, recall, accuracy, support in duck(path, columns, REPORT.format(by="cut,", group="group by cut")):
        r = report[cut]
        assert (r.precision, r.recall, r.accuracy, r.support) == pytest.approx((precision, recall, accuracy, support), abs=1e-12)
    # one fold against the library's own regression
    cut = cuts[len(cuts) // 2]
    own = score.fit_logistic(df.where(F.col("period") < cut), feat.A_MODEL_FEATURES, "default_flag")
    assert np.allclose([own.intercept, *own.coefficients], beta[cuts.index(cut)], rtol=2e-3, atol=2e-3)


def test_folds_without_both_labels_and_without_rows(spark):
    df = spark.createDataFrame([("2001", 0, 1.0), ("2001", 0, 2.0), ("2002", 1, 3.0), ("2003", 0, 0.5), ("2003", 1, None), (None, 1, 1.0)],
                               "period string, y int, x double")
    beta = backtest.fit_folds(df, ["x"], "y", "period", ["2001", "2002", "2003"])
    assert not beta[0].any() and not beta[1].any() and beta[2].any()
    got = backtest.score_folds(df, beta, ["x"], "period", ["2001", "2002", "2003"]).collect()
    assert sorted((r.period, r.cut) for r in got) == [("2001", "2001"), ("2001", "2001"), ("2002", "2002"), ("2003", "2003")]


def test_model_vote(spark):
    scores = spark.createDataFrame([(p, y, a, b) for p in ("1", "2", "3") for y, a, b in ((0, 0.1, 0.4), (1, 0.7, 0.5), (0, 0.2, None))],
                                   "period string, y int, a double, b double")
    path = land(scores)
    rows = duck(path, "*", """
        with e as (select period, sum((a - y) ** 2) as ea, count(a) as ca, sum((b - y) ** 2) as eb, count(b) as cb from t group by 1),
        w as (select period, sum(ea) over w / sum(ca) over w as ba, sum(eb) over w / sum(cb) over w as bb from e
              window w as (order by period rows between unbounded preceding and 1 preceding))
        select period, y, a, b, case when b is null then a when ba is null then (a + b) / 2 else (a / ba + b / bb) / (1 / ba + 1 / bb) end
        from t join w using (period)""")
    weights = backtest.earlier_weights(scores, ["a", "b"], "y", "period")
    got = backtest.vote(scores, weights, ["a", "b"], "period").collect()
    key = lambda r: (r[0], r[1], r[2])
    assert [r.pd_vote for r in sorted(got, key=key)] == pytest.approx([r[4] for r in sorted(rows, key=key)], abs=1e-12)


def test_memos_of_trees_compute_the_factor_tables_once(spark, monkeypatch):
    from provisio.operators import explain
    from provisio.plans import models, sme
    from provisio.queries import queries

    attributed = sme.attributed(spark, "/root/testdata/sf0.001")
    plain, calls = explain.factor_table, []

    def counted(*args):
        calls.append(args)
        return plain(*args)

    monkeypatch.setattr(models, "attributed_by_population", lambda *a, **k: attributed)
    monkeypatch.setattr(explain, "factor_table", counted)
    rows = queries()["r9_memo_trees"](spark, "/root/testdata/sf0.001").collect()
    assert len(calls) == 1
    assert len(rows) == attributed.count() and all(r.has_pd and r.has_factors for r in rows)
