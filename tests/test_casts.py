"""Casts that would change a value give null, and are counted in the pass that aligns the batch."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marea.functions.numeric import decimals
from marea.operators import drift
from marea.session import scratch_path


def cast(spark, have, values, want):
    df = spark.createDataFrame([(v,) for v in values], f"v {have}")
    return [r[0] for r in drift.align_schema(df, StructType.fromDDL(f"v {want}")).collect()]


@pytest.mark.parametrize("have, want, kept, lost", [
    ("string", "decimal(5,1)", {"12.5": Decimal("12.5"), "1250e-2": Decimal("12.5"), "12.50": Decimal("12.5"), "0e-9": Decimal("0.0")},
     ["12.75", "1e-20", "123456", "x"]),
    ("double", "decimal(5,1)", {12.5: Decimal("12.5"), 0.1: Decimal("0.1")}, [12.75, 1e20, float("nan")]),
    ("string", "int", {"12": 12, "12.0": 12, "1e3": 1000, "0.0": 0, "-7": -7, "1200e-2": 12},
     ["1e-20", "1.0000000000000000000001", "12.7", "3000000000", "1e999"]),
    ("string", "double", {"12.75": 12.75, "0": 0.0, "-0.0": -0.0, "1e-20": 1e-20}, ["1e999", "1e-999", "n/a"]),
    ("double", "int", {3.0: 3, -0.0: 0}, [12.7, 1e12]),
    ("bigint", "double", {2 ** 53: 2.0 ** 53}, [2 ** 53 + 1]),
    ("double", "float", {0.5: 0.5}, [0.1]),
    ("int", "boolean", {1: True, 0: False}, [5]),
    ("decimal(10,4)", "decimal(10,2)", {Decimal("1.5000"): Decimal("1.50")}, [Decimal("1.5001")]),
    ("string", "date", {"2024-01-05": dt.date(2024, 1, 5)}, ["2024-01-05 10:00:00", "soon"]),
    ("timestamp", "date", {dt.datetime(2024, 1, 5): dt.date(2024, 1, 5)}, [dt.datetime(2024, 1, 5, 10)]),
    ("int", "string", {5: "5"}, []),
])
def test_no_silent_change(spark, have, want, kept, lost):
    assert cast(spark, have, list(kept), want) == list(kept.values())
    assert cast(spark, have, [*lost, None], want) == [None] * (len(lost) + 1)


def test_decimals(spark):
    texts = {"12.75": 2, "1275e-2": 2, "12.0": 0, "1e3": -3, "120": -1, "0.000": None, "x": None, ".5": 1, "5.": 0, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(decimals(F.col("t"))).collect()] == list(texts.values())


def test_decimals_of_odd_spellings(spark):
    texts = {"12\n": 0, "1.5\r\n": 1, "+.5": 1, "-0012.3400E-2": 4, "1E+3": -3, "1e99999999999": 0, "12\n\n": None,
             "1.2.3": None, "1e2e3": None, "+-5": None, "e5": None, "1e": None, ".": None, "": None, " 7 ": 0}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(decimals(F.col("t"))).collect()] == list(texts.values())


def test_no_match_per_part_and_each_value_cast_once(spark):
    df = spark.createDataFrame([("1.5", "2")], "a string, b string")
    plan = df.select(decimals(F.col("a")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 0 and plan.count("RLIKE") <= 1
    aligned, _ = drift.align_and_observe(df, StructType.fromDDL("a decimal(5,1), b int"))
    plan = aligned._jdf.queryExecution().optimizedPlan().toString()
    assert "CollectMetrics" in plan and "RLIKE" not in plan.split("CollectMetrics")[0] + plan.split("CollectMetrics")[1].split("\n")[0]


@pytest.mark.parametrize("rows", [0, 1000])
def test_one_scan_gives_batch_and_report(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    df = spark.range(rows).select(F.udf(count, "string")(F.concat("id", F.lit(".25"))).alias("cust_id"),
                                  F.col("id").alias("a.b"), F.lit("x").alias("other"))
    expected = StructType.fromDDL("customer_id int, `a.b` int, gender string")
    aligned, report = drift.align_and_observe(df, expected)
    path = scratch_path(spark, "aligned")
    aligned.write.parquet(path)
    assert spark.read.parquet(path).where("customer_id is null and `a.b` is not null").count() == rows
    found = report().first()
    assert seen.value == rows
    assert found["n_rows"] == rows and found["failed_casts"] == {"customer_id": rows, "a.b": 0}
    assert found == drift.drift_report(df, expected).first()
