"""Jaro-Winkler similarity.

Spark has no built-in for it, so the score itself is an Arrow-batched pandas
UDF. It is only ever called on *distinct value pairs* that survived an exact,
JVM-side upper bound (:func:`jw_upper_bound`), and on the record edges that a report scores.

Definition (0..1): Jaro with match window max(|a|,|b|)//2 - 1, transpositions
halved; Winkler boost prefix_scale 0.1 on a common prefix of at most 4
characters, applied only when Jaro > 0.7.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro(s: str, t: str) -> float:
    ls, lt = len(s), len(t)
    if ls == 0 or lt == 0:
        return 0.0
    if s == t:
        return 1.0
    window = max(max(ls, lt) // 2 - 1, 0)
    s_flags = [False] * ls
    t_flags = [False] * lt
    m = 0
    for i, ch in enumerate(s):
        lo = max(0, i - window)
        hi = min(lt, i + window + 1)
        for j in range(lo, hi):
            if not t_flags[j] and t[j] == ch:
                s_flags[i] = t_flags[j] = True
                m += 1
                break
    if m == 0:
        return 0.0
    trans = 0
    j = 0
    for i in range(ls):
        if s_flags[i]:
            while not t_flags[j]:
                j += 1
            if s[i] != t[j]:
                trans += 1
            j += 1
    return (m / ls + m / lt + (m - trans // 2) / m) / 3.0


def jaro_winkler_py(s: str | None, t: str | None) -> float | None:
    if s is None or t is None:
        return None
    j = jaro(s, t)
    if j <= 0.7:
        return j
    prefix = 0
    for a, b in zip(s[:4], t[:4]):
        if a != b:
            break
        prefix += 1
    return j + prefix * 0.1 * (1.0 - j)


# ship this module to the Python workers by value: executors need no install of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def jaro_winkler_many(left: list[str], right: list[str]) -> np.ndarray:
    """Jaro-Winkler of many pairs at once: the loops run over character positions, each step over all pairs."""
    out = np.zeros(len(left))
    for at in range(0, len(left), 4096):
        out[at:at + 4096] = _pairs(left[at:at + 4096], right[at:at + 4096])
    return out


def _codes(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points [pair, position], padded, and the lengths."""
    lengths = np.array([len(v) for v in values])
    width = max(1, int(lengths.max(initial=0)))
    return np.array(values, f"U{width}").view(np.uint32).reshape(len(values), width), lengths


def _pairs(left: list[str], right: list[str]) -> np.ndarray:
    s, ls = _codes(left)
    t, lt = _codes(right)
    window = np.maximum(np.maximum(ls, lt) // 2 - 1, 0)
    widest = int(window.max(initial=0))
    s_hit, t_hit = np.zeros(s.shape, bool), np.zeros(t.shape, bool)
    for i in range(s.shape[1]):
        free = i < ls
        for j in range(max(0, i - widest), min(t.shape[1], i + widest + 1)):
            hit = free & (j < lt) & (abs(i - j) <= window) & ~t_hit[:, j] & (s[:, i] == t[:, j])
            t_hit[:, j] |= hit
            s_hit[:, i] |= hit
            free &= ~hit
    m = s_hit.sum(axis=1)
    # matched characters of both sides in order: positions that differ are transpositions
    k = min(s.shape[1], t.shape[1])
    sm = np.take_along_axis(s, np.argsort(~s_hit, axis=1, kind="stable"), 1)[:, :k]
    tm = np.take_along_axis(t, np.argsort(~t_hit, axis=1, kind="stable"), 1)[:, :k]
    moved = ((sm != tm) & (np.arange(k) < m[:, None])).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        j = np.where(m > 0, (m / ls + m / lt + (m - moved) / m) / 3.0, 0.0)
    same = np.ones(len(left), bool)
    prefix = np.zeros(len(left))
    for i in range(min(4, k)):
        same &= (s[:, i] == t[:, i]) & (i < ls) & (i < lt)
        prefix += same
    return np.where(j > 0.7, j + prefix * 0.1 * (1.0 - j), j)


@F.pandas_udf(T.DoubleType())
def _jw_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    if known.any():
        out[known] = jaro_winkler_many(a[known].tolist(), b[known].tolist())
    return pd.Series(out).where(known, None).astype("float64")


def jaro_winkler(a, b) -> Column:
    """Jaro-Winkler similarity in 0..1 (NULL when either side is NULL)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return _jw_udf(a, b)


def tagged_chars(c) -> Column:
    """Characters tagged with their occurrence number ('ANNA' -> A1 N1 N2 A2).

    The size of the intersection of two tagged arrays is the multiset
    character overlap, an upper bound of the Jaro match count.
    """
    c = F.col(c) if isinstance(c, str) else c
    chars = F.split(c, "")
    return F.transform(
        chars,
        lambda x, i: F.concat(x, F.size(F.filter(F.slice(chars, 1, i + 1), lambda y: y == x)).cast("string")),
    )


def jw_upper_bound(len_a, len_b, overlap) -> Column:
    """Exact upper bound of Jaro-Winkler from lengths and character overlap.

    m <= min(overlap, |a|, |b|), transpositions >= 0, prefix <= 4:
    J <= (m/|a| + m/|b| + 1) / 3 and JW <= J + 0.4 (1 - J).
    """
    m = F.least(overlap, len_a, len_b).cast("double")
    j = F.when(m == 0, F.lit(0.0)).otherwise((m / len_a + m / len_b + 1.0) / 3.0)
    return j + 0.4 * (1.0 - j)
