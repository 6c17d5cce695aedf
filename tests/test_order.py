"""Radix selection against numpy and the bits of doubles."""

import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marea.functions.numeric import order_key
from marea.operators import ordered


def bits(x: float) -> int:
    whole = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -whole if x < 0 else whole


def test_order_key_is_the_bits(spark):
    rng = np.random.default_rng(5)
    values = [0.0, -0.0, 1.0, -1.0, 2.0, 5e-324, -5e-324, 2.0 ** -1022, np.nextafter(2.0 ** -1022, 0), 1.7976931348623157e308,
              float("inf"), float("-inf")]
    values += [np.nextafter(2.0 ** e, to) for e in range(-1021, 1024, 7) for to in (0, np.inf)] + [2.0 ** e for e in range(-1074, 1024, 5)]
    values += list(np.frombuffer(rng.bytes(8 * 4000), dtype="<f8"))
    values = [float(v) for v in values if not np.isnan(v)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_key(F.col("v")).alias("key")).collect()
    assert [(r["v"], r["key"]) for r in rows] == [(v, bits(v)) for v in values]
    odd = spark.createDataFrame([(float("nan"),), (None,)], "v double").select(order_key(F.col("v"))).collect()
    assert [r[0] for r in odd] == [None, None]


@pytest.mark.parametrize("bins", [None, 1, 1 << 40])
def test_quantiles_of_millions_with_one_heavy_value(spark, bins):
    """A fifth of the rows hold one value, many others differ in their last bits only."""
    n = 10_000_000 if bins is None else 200_000
    rows = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
        F.when(F.col("id") % 5 == 1, 0.75).when(F.col("id") % 5 == 2, 0.75 + (F.col("id") % 1000) * 2.0 ** -52)
        .otherwise((F.pmod(F.col("id") * 7919, F.lit(n)) - n // 3) / n).alias("v"))
    ids = np.arange(n)
    value = np.where(ids % 5 == 1, 0.75, np.where(ids % 5 == 2, 0.75 + (ids % 1000) * 2.0 ** -52, ((ids * 7919) % n - n // 3) / n))
    probs = {"least": 0.0, "q1": 0.25, "median": 0.5, "p81": 0.81, "p97": 0.97, "most": 1.0}
    found = ordered.exact_quantiles(ordered.binned_values(rows, ["v"], "g", bins), "g", probs).collect()
    assert {r["g"] for r in found} == {"a", "b"}
    for r in found:
        own = value[(ids % 3 == 0) == (r["g"] == "a")]
        assert r["n"] == len(own)
        assert [r[p] for p in probs] == pytest.approx(list(np.quantile(own, list(probs.values()))), rel=1e-15, abs=1e-18)


def test_infinite_and_repeated_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([("x", v) for v in (inf, inf, -inf, 1.0, float("nan"), None)] + [("y", -0.0), ("y", 0.0)],
                               "g string, v double")
    rows = {r["g"]: r for r in ordered.exact_quantiles(ordered.binned_values(df, ["v"], "g"), "g", {"low": 0.0, "top": 1.0}).collect()}
    assert (rows["x"]["n"], rows["x"]["low"], rows["x"]["top"]) == (4, -inf, inf)
    assert (rows["y"]["n"], rows["y"]["low"], rows["y"]["top"]) == (2, 0.0, 0.0)
    assert ordered.exact_quantiles(ordered.binned_values(df.where("g = 'z'"), ["v"], "g"), "g", {"m": 0.5}).count() == 0


def test_auc_by_prefix_sums_over_negative_and_close_scores(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 4000)
    s = np.concatenate([rng.normal(0, 1, 2000), 1 + rng.integers(0, 300, 1000) * 2.0 ** -52, np.full(1000, -3.5)])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    rank = pd.Series(s).rank().to_numpy()
    p = int(y.sum())
    expected = (rank[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))
    for bins in (None, 1, 1 << 30):
        row = ordered.auc_roc(df, "y", "s", bins).first()
        assert (row["n_pos"], row["n_neg"]) == (p, 4000 - p) and row["auc"] == pytest.approx(expected, abs=1e-12)
