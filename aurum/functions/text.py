"""String normalisation, blocking keys, hashes and tiers as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aurum import rules


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.length(F.trim(c)) > 0, c)


def capitalise(c) -> Column:
    """Trimmed, lower-cased, and a capital after every non-letter ('anne-marie o'brien' -> 'Anne-Marie O'Brien')."""
    parts = F.split(F.lower(F.trim(_c(c))), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), "")


def title_case(c) -> Column:
    """Capitalised text; blank -> NULL (stream mappers do the same)."""
    c = _c(c)
    return F.when(F.length(F.trim(c)) > 0, capitalise(c))


def norm_email(c) -> Column:
    c = _c(c)
    return F.when(F.length(F.trim(c)) > 0, F.lower(F.trim(c)))


def norm_phone(c) -> Column:
    """Keep digits and '+'; empty result -> NULL."""
    d = F.regexp_replace(_c(c), r"[^0-9+]", "")
    return F.when(F.length(d) > 0, d)


def digits(c) -> Column:
    return F.regexp_replace(_c(c), r"[^0-9]", "")


def phone_suffix(c, n: int) -> Column:
    """Last n digits, NULL when the value has fewer than n digits."""
    d = digits(c)
    return F.when(F.length(d) >= n, F.substring(d, -n, n))


def email_domain(c) -> Column:
    """Domain from '@' onward ('bill@acme.com' -> '@acme.com'); NULL without '@'."""
    c = _c(c)
    pos = F.instr(c, "@")
    return F.when(pos > 0, F.substr(c, pos))


def soundex_nordic(c) -> Column:
    """SOUNDEX with Æ/Ø/Å folded first (Spark returns non-A-Z input unchanged)."""
    c = _c(c)
    folded = F.translate(F.upper(c), "ÆØÅÄÖÜÉ", "AOAAOUE")
    return F.when(F.length(F.trim(c)) > 0, F.soundex(folded))


def row_hash(*cols, sep: str = "|") -> Column:
    """SHA-256 over tracked attributes, NULL -> '' (dates as yyyy-MM-dd)."""
    return F.sha2(F.concat_ws(sep, *[F.coalesce(_c(x).cast("string"), F.lit("")) for x in cols]), 256)


def dq_tier(c) -> Column:
    c = _c(c)
    expr = None
    for bound, label in rules.DQ_TIERS:
        expr = F.when(c >= bound, label) if expr is None else expr.when(c >= bound, label)
    return expr.otherwise(rules.DQ_TIER_FLOOR)


def full_name(first, last) -> Column:
    return F.concat_ws(" ", _c(first), _c(last))
