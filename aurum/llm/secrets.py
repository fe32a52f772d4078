"""Secret scans: patterns, and character Markov models for random strings.

Base spans come from three fixed patterns. Further spans are found by two
order-1 character Markov models, one of random strings and one of ordinary
identifiers, both trained from labelled samples: the values of base matches
are labelled random, the other words of the same sampled texts ordinary. A
token outside the base spans is reported when the log-likelihood ratio of the
two models is over a threshold, in total and per character.

Semantics: null text is empty. Offsets are code points, ends exclusive. Where
no labelled secret exists the models do not run and only base spans are
returned. Character classes and letter case are those of ASCII; characters
outside the models' alphabet break a token.
"""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import replace_spans, ship_by_value, text_or_empty

ship_by_value(__name__)

# fixed values of the contract
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # AKIA[A-Z0-9]+ of 18 or more: a shorter run has no match at all
HEX = re.compile(r"[0-9a-f]{16,}")
#: texts without this have no base match
MAY_MATCH = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"""
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 12

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CODE = {c: i + 1 for i, c in enumerate(ALPHABET)}  # 0: start of a token
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
WORD = re.compile(r"[A-Za-z0-9+/_=-]{4,}")


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, start of the value) of the base patterns."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(out)


def _labelled(batches):
    """Hashes of the texts that have a base match."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("h").filter(pa.array([bool(base_spans(t)) for t in b.column("text").to_pylist()], pa.bool_()))], names=["h"])


def _transitions(batches):
    """Transition counts of labelled strings: (random or not, from, to, count)."""
    counts = np.zeros((2, len(CODE) + 1, len(CODE) + 1), np.int64)
    for b in batches:
        for text in b.column("text").to_pylist():
            spans = base_spans(text)
            if not spans:
                continue
            rest, at = [], 0
            for start, _, end, value in spans:
                rest.append(text[at:start])
                at = max(at, end)
                _count(counts[1], text[value:end])
            rest.append(text[at:])
            for part in rest:
                for w in WORD.findall(part):
                    _count(counts[0], w)
    label, a, b = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[label, a, b])],
                                     names=["label", "a", "b", "n"])


def _count(matrix: np.ndarray, word: str) -> None:
    codes = [0, *[CODE[c] for c in word if c in CODE]]
    for a, b in pairwise(codes):
        matrix[a, b] += 1


def fit(docs: DataFrame, text: str = "text", fit_rows: int = 20_000, smoothing: float = 0.5) -> np.ndarray | None:
    """Log-likelihood ratios [from, to] of random over ordinary transitions.

    ``fit_rows`` bounds the labelled sample: the expected number of texts with a base match, taken by a hash of the
    text; the smallest hash is always in. None means that no text has a base match.
    """
    likely = docs.select(text_or_empty(text).alias("text")).where(F.col("text").rlike(MAY_MATCH)) \
        .withColumn("h", F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
    n, least = likely.mapInArrow(_labelled, "h long").agg(F.count("*"), F.min("h")).first()
    if not n:
        return None
    sample = likely.where(F.col("h") < max(min(1.0, fit_rows / n) * (1 << 20), least + 1))
    got = sample.mapInArrow(_transitions, "label int, a int, b int, n long").groupBy("label", "a", "b").agg(F.sum("n").alias("n"))
    counts = np.full((2, len(CODE) + 1, len(CODE) + 1), smoothing)
    for r in got.collect():  # at most 2 x alphabet x alphabet rows
        counts[r["label"], r["a"], r["b"]] += r["n"]
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    return logs[1] - logs[0]


def _scan(model: np.ndarray | None, least: float, least_per_char: float):
    ratio = None if model is None else model.tolist()

    def run(batches):
        for b in batches:
            spans = []
            for text in b.column("_text").to_pylist():
                found = base_spans(text)
                if ratio is not None:
                    found += _random(text, found, ratio, least, least_per_char)
                spans.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e, *_ in sorted(found)])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            names = [n for n in b.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(spans, kind)], names=[*names, "secrets"])
    return run


def _random(text: str, base: list, ratio: list, least: float, least_per_char: float) -> list[tuple[int, int, int]]:
    out = []
    taken = sorted((s, e) for s, _, e, _ in base)
    for m in TOKEN.finditer(text):
        word = m[0]
        score = sum(ratio[a][b] for a, b in pairwise([0, *map(CODE.__getitem__, word)]))
        if score >= least and score >= least_per_char * len(word) and not any(s < m.end() and m.start() < e for s, e in taken):
            out.append((m.start(), 3, m.end()))
    return out


def scan(docs: DataFrame, model: np.ndarray | None, text: str = "text", least: float = 12.0, least_per_char: float = 0.6) -> DataFrame:
    """``docs`` with ``secrets``: an array of (kind, start, end), by start, then kind (a narrow map).

    A column ``secrets`` of the input is replaced.
    """
    rest = docs.drop("secrets").withColumn("_text", text_or_empty(text))
    empty = rest.withColumn("secrets", F.array().cast("array<struct<kind:string,start:int,end:int>>")).drop("_text")
    return rest.mapInArrow(_scan(model, least, least_per_char), empty.schema)


def mask(docs: DataFrame, model: np.ndarray | None, text: str = "text", with_: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced (overlapping spans once)."""
    found = scan(docs, model, text)
    return found.withColumn(text, F.when(F.size("secrets") > 0, replace_spans(F.col(text), F.col("secrets"), with_)).otherwise(F.col(text))).drop("secrets")
