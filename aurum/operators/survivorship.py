"""Declarative survivorship: one shuffle, one ``min_by`` per attribute (GD-04, R4).

A rule is (output, value, order keys, valid). Among the rows of a group the
value of the row with the smallest order struct wins. Rows whose value is
not valid get a NULL order struct and are skipped by ``min_by``; with
``fallback=True`` they still compete after all valid rows (pairwise variant,
where FIRST_VALUE does not skip invalid values).

Partial aggregation runs map-side, so a group holding a third of all rows
is combined before the shuffle instead of landing whole on one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum import rules


@dataclass
class Rule:
    output: str
    value: Column
    order: list[Column]
    valid: Column | None = None
    fallback: bool = False
    extra: list[Column] = field(default_factory=list)


def desc_date(c) -> Column:
    """Ascending key that sorts dates newest first (NULL last)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.datediff(F.lit(rules.OPEN_END).cast("date"), c), F.lit(1 << 30))


def rule_agg(rule: Rule) -> Column:
    keys = list(rule.order)
    if rule.fallback:
        flag = F.when(rule.valid, F.lit(0)).otherwise(F.lit(1)) if rule.valid is not None else F.lit(0)
        order = F.struct(flag.alias("_inv"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    else:
        order = F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys)])
        if rule.valid is not None:
            order = F.when(rule.valid, order)
    return F.min_by(rule.value, order).alias(rule.output)


def survive(df: DataFrame, group_cols: list[str], rule_list: list[Rule], extra_aggs: list[Column] | None = None) -> DataFrame:
    aggs = [rule_agg(r) for r in rule_list] + list(extra_aggs or [])
    return df.groupBy(*group_cols).agg(*aggs)
