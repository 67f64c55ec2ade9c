"""Exact quantiles against Spark's own, with brackets that have to narrow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from probeloom import quantiles


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    values = {
        "normal": rng.normal(size=5000), "ties": np.round(rng.exponential(size=3000), 1), "few": rng.normal(size=40), "one": np.array([2.5]),
        "mostly one value": np.where(rng.random(4000) < 0.6, 7.0, rng.normal(size=4000) * 10), "magnitudes": 10.0 ** rng.uniform(-300, 300, 2500), "constant": np.zeros(3000), "ends": np.r_[np.zeros(1500), np.ones(1500)], "none": np.zeros(0),
    }
    rows = [(k, float(x), i % 2) for k, v in values.items() for i, x in enumerate(v)] + [(k, None, 0) for k in values]
    return spark.createDataFrame(rows, "key string, x double, n int").repartition(6).cache()


PROBABILITIES = [0.0, 0.1, 0.4, 0.5, 0.6, 0.999, 1.0]


@pytest.mark.parametrize("limit", [50, 1000, 10**6])
def test_quantiles_are_exact(table, limit):
    plain = table.groupBy("key").agg(F.count("x").alias("n"), F.percentile("x", F.array(*map(F.lit, PROBABILITIES))).alias("q"))
    got = quantiles.exact_quantiles(table, ["key"], "x", PROBABILITIES, limit)
    key = lambda r: r["key"]
    assert sorted(got.select("key", "n", "q").collect(), key=key) == sorted(plain.collect(), key=key)


def test_rows_get_their_keys_quantiles(spark, table, monkeypatch):
    plain = {r["key"]: r["m"] for r in table.groupBy("key").agg(F.percentile("x", 0.5).alias("m")).collect()}
    for limit, keys in ((100, 50_000), (100, 0)):
        monkeypatch.setattr(quantiles, "MAX_HOT_KEYS", keys)
        monkeypatch.setattr("probeloom.spread.HOT_ROWS", 1000)
        rows = quantiles.with_quantiles(table, ["key"], F.col("x"), [0.5], "q", limit)
        assert rows.columns == ["key", "x", "n", "q"] and rows.count() == table.count()
        assert {r["key"]: r["q"][0] if r["q"] else None for r in rows.select("key", "q").distinct().collect()} == plain


def test_no_rows(table):
    assert quantiles.with_quantiles(table.limit(0), ["key"], "x", [0.5], "q").count() == 0
