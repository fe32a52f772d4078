"""National-id checks: modulus-11 control digits and DDMMYY date validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aurum import rules


def _digit(c: Column, i: int) -> Column:
    return F.substring(c, i, 1).cast("int")


def _control(rem: Column) -> Column:
    # remainder 0 -> 0, remainder 1 -> no valid digit (NULL), else 11 - r
    return F.when(rem == 0, F.lit(0)).when(rem == 1, F.lit(None).cast("int")).otherwise(11 - rem)


def ssn_mod11_valid(c) -> Column:
    """TRUE when the 11-digit id carries both correct control digits."""
    c = F.col(c) if isinstance(c, str) else c
    ok_format = c.isNotNull() & c.rlike(rules.SSN_PATTERN)
    d = [_digit(c, i) for i in range(1, 12)]
    s1 = sum((w * d[i] for i, w in enumerate(rules.SSN_WEIGHTS_1)), F.lit(0))
    s2 = sum((w * d[i] for i, w in enumerate(rules.SSN_WEIGHTS_2)), F.lit(0))
    k1 = _control(s1 % 11)
    k2 = _control(s2 % 11)
    valid = k1.isNotNull() & k2.isNotNull() & (k1 == d[9]) & (k2 == d[10])
    return F.when(ok_format, F.coalesce(valid, F.lit(False))).otherwise(F.lit(False))


def ssn_date_valid(c) -> Column:
    """11 digits and the first six parse as a DDMMYY date."""
    c = F.col(c) if isinstance(c, str) else c
    ok_format = c.isNotNull() & c.rlike(rules.SSN_PATTERN)
    parsed = F.try_to_timestamp(F.substring(c, 1, 6), F.lit("ddMMyy"))
    return F.when(ok_format, parsed.isNotNull()).otherwise(F.lit(False))
