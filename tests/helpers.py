"""Applies a column expression to a list of values, in order."""

from __future__ import annotations

from pyspark.sql import functions as F


def apply(spark, values, expression, kind="string"):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, f"n int, x {kind}").repartition(2)
    found = df.select("n", expression(F.col("x")).alias("y")).collect()
    return [row["y"] for row in sorted(found, key=lambda r: r["n"])]
