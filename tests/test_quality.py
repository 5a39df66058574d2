"""Quality checks on literal inputs: bounds, empty previous snapshot, gate decision."""

from pyspark.sql import functions as F

from changeledger.operators import quality as qc


def test_partition_presence_with_explicit_bounds(spark):
    days = spark.createDataFrame([("2024-01-02",), ("2024-01-04",)], "dt string") \
        .withColumn("dt", F.to_date("dt"))
    missing = qc.partition_presence(days, "2024-01-01", "2024-01-05")
    assert sorted(str(r[0]) for r in missing.collect()) == ["2024-01-01", "2024-01-03", "2024-01-05"]


def test_row_count_delta_from_empty_previous(spark):
    prev = spark.createDataFrame([], "k string")
    cur = spark.createDataFrame([("a",), ("b",)], "k string")
    row = qc.row_count_delta(prev, cur, 0.5).first()
    assert (row["previous_rows"], row["current_rows"], row["change_ratio"], row["passed"]) == (0, 2, 1.0, False)
    row = qc.row_count_delta(prev, prev, 0.5).first()
    assert row["change_ratio"] == 0.0 and row["passed"]


def test_null_rates_and_gate(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", 2.0), ("c", 3.0)], "k string, v double")
    rates = {r["column_name"]: r["null_rate"] for r in qc.null_rates(df, ["k", "v"]).collect()}
    assert rates == {"k": 0.0, "v": 0.25}
    report = qc.quality_report(df, df, ["k"], ["k", "v"], max_null_rate=0.5)
    got = {r["check_name"]: r["passed"] for r in report.collect()}
    assert got == {"row_count_delta": True, "null_rate:k": True, "null_rate:v": True,
                   "duplicate_keys": False}
    assert not qc.all_passed(report)
