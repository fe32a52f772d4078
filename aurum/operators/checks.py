"""Quality gates as queries: each check returns (check_name, violations, result) (CK-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(name: str, violations: DataFrame) -> DataFrame:
    """One summary row for a DataFrame of violating rows (one aggregate, no collect)."""
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations",
        F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("result"))


def union_checks(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def out_of_bounds(df: DataFrame, col: str, lo: int = 0, hi: int = 100) -> DataFrame:
    return df.where((F.col(col) < lo) | (F.col(col) > hi) | F.col(col).isNull())


def duplicated(df: DataFrame, keys: list[str], pred: Column | None = None) -> DataFrame:
    d = df if pred is None else df.where(pred)
    return d.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
