"""Similar-value search for fuzzy name matching (JN-01, R2).

Record pairs are never formed here: the search runs on the *distinct values*
of each side (copies of a name collapse to one row) and keeps the value pairs
whose Jaro-Winkler similarity reaches a threshold. Everything before the score
itself is an exact filter on the JVM side:

1. signatures. With p common leading characters (p = 0..4), JW >= t needs
   Jaro >= (t - 0.1 p) / (1 - 0.1 p), hence at least need(p) matching characters
   in either value. Two values with that many characters in common share one
   of the first length - need(p) + 1 characters of each, in a fixed order that
   starts with rare letters. So every value emits (p, leading characters,
   character) for those, and candidates are an equi-join on that signature;
2. the multiset character overlap bounds the Jaro match count, hence JW from
   above.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.functions.similarity import jaro_winkler
from aurum.session import written

# letters from rare to common: only an order, any one is right
RARITY = "QXZWÆØÅCJYVPFUBGMDHKTOLISRNAE"
#: up to so many values on the right a block's values meet directly; a name of 12 letters has about 40 signatures
SMALL_BLOCK = 32


def _share(threshold: float, prefix: int) -> float:
    """Least share of a value's characters that must match when ``prefix`` leading characters agree."""
    j = (threshold - 0.1 * prefix) / (1.0 - 0.1 * prefix)
    return max(0.0, 3.0 * j - 2.0)


def _signatures(value: str, ranked: str, threshold: float) -> str:
    """SQL of the signatures by which any partner with JW >= threshold (and > 0) is met; ``ranked`` as :func:`_ranked` orders it.

    SQL text, as thousands of single calls to the JVM would build the same expression.
    """
    parts = []
    for p in range(5):
        need = f"greatest(1, CAST(ceil(length({value}) * {_share(threshold, p):.17g}D - 1e-9D) AS INT))"
        own = f"transform(slice({ranked}, 1, greatest(0, length({value}) - {need} + 1)), s -> concat('{p}', substring({value}, 1, {p}), '|', s.x))"
        parts.append(f"CASE WHEN length({value}) >= {p} THEN {own} ELSE CAST(array() AS ARRAY<STRING>) END")
    return f"array_distinct(concat({', '.join(parts)}))"


def _tags(value: str) -> str:
    """SQL of :func:`aurum.functions.similarity.tagged_chars`."""
    return f"transform(split({value}, ''), (x, i) -> concat(x, CAST(size(filter(slice(split({value}, ''), 1, i + 1), y -> y = x)) AS STRING)))"


def _ranked(tags: str) -> str:
    """SQL of the tagged characters from rare to common; second and later occurrences of a letter are rarer than first ones."""
    return f"array_sort(transform({tags}, x -> struct(-CAST(substring(x, 2, 4) AS INT) AS k, instr('{RARITY}', upper(substring(x, 1, 1))) AS r, x AS x)))"


def candidates(left: DataFrame, right: DataFrame, threshold: float, lcol: str = "value", rcol: str = "value",
               keys: list[str] | None = None) -> DataFrame:
    """Distinct value pairs (keys..., left_value, right_value) that may reach the threshold.

    In a block of few values every value meets every other: fewer rows than its signatures. Other values meet by
    signature. Both joins are sort merge joins: size estimates count a value once, not its signatures, so a side far
    over the broadcast threshold would be built in the driver.
    """
    keys = keys or []

    def side(df: DataFrame, col: str, name: str) -> DataFrame:
        v = df.select(*keys, F.col(col).alias(name)).where(F.col(name).isNotNull() & (F.length(name) > 0)).distinct()
        # a value's characters are tagged once; pairs only intersect them
        return v.withColumn(f"{name}_tags", F.expr(_tags(name)))

    def signed(v: DataFrame, name: str) -> DataFrame:
        ranked = v.withColumn("ranked", F.expr(_ranked(f"{name}_tags")))
        return ranked.withColumn("signature", F.explode(F.expr(_signatures(name, "ranked", threshold)))).drop("ranked")

    def met(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        pairs = a.join(b.hint("merge"), on)
        # jw_upper_bound >= threshold, solved for the overlap (at least one character is shared)
        overlap = F.size(F.array_intersect("left_value_tags", "right_value_tags"))
        per_match = F.lit(1.0) / F.length("left_value") + F.lit(1.0) / F.length("right_value")
        return pairs.where((overlap > 0) & (overlap * per_match >= F.lit(5.0 * (threshold - 0.4) - 1.0 - 1e-9))).select(*keys, "left_value", "right_value")

    a, b = side(left, lcol, "left_value"), side(right, rcol, "right_value")
    if not keys:
        return met(signed(a, "left_value"), signed(b, "right_value"), ["signature"]).distinct()
    small = F.col("values") <= SMALL_BLOCK
    # both joins read written values; a search of values among themselves writes them once
    b = written(b)
    sizes = b.groupBy(*keys).agg(F.count("*").alias("values"))
    alike = left is right and lcol == rcol
    a = None if alike else written(a.join(sizes.hint("merge"), keys))
    b = written(b.join(sizes.hint("merge"), keys))
    if alike:
        a = b.withColumnsRenamed({"right_value": "left_value", "right_value_tags": "left_value_tags"})
    few = met(a.where(small).drop("values"), b.where(small).drop("values"), keys)
    many = met(signed(a.where(~small).drop("values"), "left_value"), signed(b.where(~small).drop("values"), "right_value"), [*keys, "signature"])
    return few.unionByName(many.distinct())


def similar_values(left: DataFrame, right: DataFrame, threshold: float,
                   lcol: str = "value", rcol: str = "value", keys: list[str] | None = None) -> DataFrame:
    """Distinct value pairs (keys..., left_value, right_value, jw) with jw >= threshold and > 0.

    ``keys`` restricts the search to values sharing the key columns (a block).
    """
    scored = candidates(left, right, threshold, lcol, rcol, keys).withColumn(
        "jw", F.when(F.col("left_value") == F.col("right_value"), F.lit(1.0))
        .otherwise(jaro_winkler("left_value", "right_value")))
    return scored.where((F.col("jw") >= F.lit(threshold)) & (F.col("jw") > 0))
