"""Edge cases with expected results (FIXTURES.md §4) for the column helpers."""

import pytest
from pyspark.sql import functions as F

from provisio.functions import scalars as sc, text as tx
from provisio.operators import features as feat

EMP_CASES = [(None, None), ("n/a", None), ("N/A", 0), ("10+ years", 10), ("< 1 year", 0), ("1 year", 1),
             ("2 years", 2), ("9 years", 9), ("10 years", 1), ("11 years", 1), ("12 years", 2), ("15 years", 5),
             ("3 yrs", 3), ("5 YEARS", 5), ("junk", 0), ("", 0)]


def test_emp_years_rule_order(spark):
    df = spark.createDataFrame([(t,) for t, _ in EMP_CASES], "t string")
    got = [r[0] for r in df.select(sc.emp_years("t")).collect()]
    assert got == [y for _, y in EMP_CASES]


def test_pct_to_fraction(spark):
    df = spark.createDataFrame([("13.99%",), ("13.99",), (None,), ("abc",)], "r string")
    got = [r[0] for r in df.select(sc.pct_to_fraction("r")).collect()]
    assert got[0] == pytest.approx(0.1399) and got[1] == pytest.approx(0.1399)
    assert got[2] is None and got[3] == 0.0


def test_lenient_casts(spark):
    df = spark.createDataFrame([("12.5%",), ("abc",), ("n",), (" 36 months",), (None,)], "s string")
    got = df.select(sc.lenient_real("s").alias("r"), sc.lenient_int("s").alias("i")).collect()
    assert [r.r for r in got] == [12.5, 0.0, 0.0, 36.0, None]
    assert [r.i for r in got] == [12, 0, 0, 36, None]


def test_term_months(spark):
    df = spark.createDataFrame([(" 36 months",), (" 60 months",), (None,), ("x",)], "t string")
    assert [r[0] for r in df.select(sc.term_months("t")).collect()] == [36, 60, None, None]


def test_dti_from_text(spark):
    df = spark.createDataFrame([(None, 12000.0, 100.0), (None, 0.0, 100.0), (30.0, 1.0, 1.0)],
                               "dti double, inc double, inst double")
    got = [r[0] for r in df.select(sc.dti_from_text(F.col("dti"), F.col("inc"), F.col("inst"))).collect()]
    assert got[0] == pytest.approx(0.1) and got[1] is None and got[2] == pytest.approx(0.3)


@pytest.mark.parametrize("values,fn,expected", [
    ([750, 749, 700, 650, 580, 579, None], feat.credit_bucket_b,
     ["Excellent", "Good", "Good", "Fair", "Poor", "Very Poor", "Very Poor"]),
    ([579, 580, 669, 670, 739, 740, None], feat.fico_category_a,
     ["Poor", "Fair", "Fair", "Good", "Good", "Excellent", "Excellent"]),
    ([20000, 20000.01, 50000, 50000.01], feat.loan_size_a, ["Small", "Medium", "Medium", "Large"]),
    ([9999.99, 10000, 25000], feat.loan_size_b, ["Small", "Medium", "Large"]),
    ([0.36, 0.43, None], feat.dti_risk_category, ["Medium Risk", "High Risk", "Low Risk"]),
])
def test_bins(spark, values, fn, expected):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
    assert [r[0] for r in df.select(fn("x")).collect()] == expected


def test_bins_as_range_join_match_case(spark):
    vals = [(float(v),) for v in (300, 579, 580, 669.5, 670, 739, 740, 850)] + [(None,)]
    df = spark.createDataFrame(vals, "x double").withColumn("k", F.monotonically_increasing_id())
    bins = feat.bins_table(spark, feat.A_FICO_BINS, name="a", otherwise=feat.A_FICO_TOP, op="<")
    joined = feat.bin_by_range_join(df, "x", bins, out="label", null_label=feat.A_FICO_TOP)
    got = sorted((r.k, r.label) for r in joined.collect())
    want = sorted((r.k, r.label) for r in df.select("k", feat.fico_category_a("x").alias("label")).collect())
    assert got == want


def test_money_format(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1e9,), (1.5e9,), (-2e9,), (1234567.4,)], "v double")
    got = [r[0] for r in df.select(tx.fmt_money("v")).collect()]
    assert got == ["N/A", "N/A", "1,000,000,000", "1.50 B", "-2,000,000,000", "1,234,567"]


def test_number_formats(spark):
    df = spark.createDataFrame([(0.1234, -0.5)], "a double, b double")
    r = df.select(tx.fmt_pct1("a"), tx.fmt_pct2("a"), tx.fmt_fixed("a", 2), tx.fmt_signed_pct0("b"),
                  tx.fmt_signed_pct0(F.lit(0.1))).first()
    assert tuple(r) == ("12.3%", "12.34%", "0.12", "-50%", "+10%")


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (2.0,), (0.5,)], "p double")
    assert [r[0] for r in df.select(sc.clip(F.col("p"), 0.001, 0.999)).collect()] == [None, 0.001, 0.999, 0.5]


def test_display_name(spark):
    df = spark.createDataFrame([("industry_Tech",), ("revenue_growth",)], "f string")
    assert [r[0] for r in df.select(tx.display_feature_name("f")).collect()] == ["Sector: Tech", "revenue_growth"]
