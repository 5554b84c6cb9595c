"""Operator 3 against the same draw in plain Python, and its distribution."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from provisio.llm import mixing


def brute_copies(rate, u):
    total, k, log_factorial, n = 0.0, 0, 0.0, 0
    while k <= math.ceil(rate + 12 * math.sqrt(rate) + 30):
        if k > 1:
            log_factorial += math.log(k)
        total += math.exp(k * math.log(rate) - rate - log_factorial) if rate > 0 else float(k == 0)
        n += total <= u
        k += 1
    return n


def uniform(doc_id, text):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    key = f"{mixing.SEED}|{'' if doc_id is None else doc_id}|{inner}"
    return int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16 ** 13


def brute(rows):
    """rows: (doc_id, text, source) -> Counter of (doc_id, text, copy_no)."""
    size = Counter()
    for _, t, s in rows:
        size[s] += len(t or "")
    rate = {s: sum(size.values()) / (len(size) * n) if n else 1.0 for s, n in size.items()}
    return Counter((d, t, k) for d, t, s in rows for k in range(brute_copies(rate[s], uniform(d, t))))


def test_copies_equal_the_plain_draw(documents, rows):
    got = mixing.mix(documents).collect()
    assert Counter((r.doc_id, r.text, r.copy_no) for r in got) == brute([(r["doc_id"], r["text"], r["source"]) for r in rows])
    keys = [r.shuffle_key for r in got]
    assert keys == sorted(keys)


def test_edge_rows(edge, empty):
    got = mixing.mix(edge)
    assert set(edge.columns) | {"copy_no"} == set(got.columns)
    assert Counter((r.doc_id, r.text, r.copy_no) for r in got.collect()) == brute([(r.doc_id, r.text, r.source) for r in edge.collect()])
    assert mixing.mix(empty).count() == 0


def test_weights_set_the_shares(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("four").alias("text"),
                                      F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 30 == 1, "b").otherwise("c").alias("source"))
    got = {r.source: r["count"] for r in mixing.mix(docs, {"a": 1, "b": 1, "c": 0}).groupBy("source").count().collect()}
    assert set(got) == {"a", "b"}
    assert all(abs(n - 15_000) < 600 for n in got.values())


@pytest.mark.parametrize("rate", [0.2, 3.7, 900.0])
def test_steps_are_the_poisson_distribution(spark, rate):
    row = mixing.poisson_steps(spark.createDataFrame([("s", rate)], "source string, rate double")).first()
    steps = [0.0] * row.least + row.steps
    k = np.arange(len(steps))
    log_p = k * math.log(rate) - rate - np.array([math.lgamma(x + 1) for x in k])
    assert np.allclose(steps, np.cumsum(np.exp(log_p)), atol=1e-9) and steps[-1] > 1 - 1e-9


def test_a_rate_of_a_million_takes_seconds(spark):
    import time

    from pyspark.sql import functions as F

    rates = spark.createDataFrame([("big", 1_000_000.0), ("mid", 5000.5), ("one", 1.0), ("none", 0.0), (None, 0.3)], "source string, rate double")
    start = time.time()
    steps = {r.source: (r.least, r.steps) for r in mixing.poisson_steps(rates).collect()}
    assert time.time() - start < 20
    for name, rate in (("big", 1_000_000.0), ("mid", 5000.5)):
        least, cdf = steps[name]
        assert cdf == sorted(cdf) and abs(cdf[-1] - 1) < 1e-6 and len(cdf) < 25 * rate ** 0.5 + 100
        mean = least + sum(1 - c for c in cdf)
        assert abs(mean - rate) < 1e-3 * rate ** 0.5
    assert steps["none"][0] == 0 and steps["none"][1][0] == 1.0
    assert abs(steps["one"][1][0] - 0.36787944117144233) < 1e-14
    docs = spark.range(4).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("source"))
    assert abs(mixing.mix(docs, total=100_000.0).count() / 400_000 - 1) < 0.01
