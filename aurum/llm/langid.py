"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary
(``piece_bpe_32k``; letters outside it fall back to its 256 byte pieces). The
probability of a word is the sum over *all* its segmentations into pieces,
computed by the forward algorithm; pieces never cross a word, so the
log-likelihood of a text is the sum over its words and a word is scored once
per Python worker. Piece probabilities are fitted by expectation maximisation
(forward-backward over the same lattices): the E-step runs on the executors
over the word counts of a bounded sample of labelled rows, the M-step is a
Spark aggregation by (language, piece), bounded by vocabulary x languages.

Semantics: a word is a maximal run of letters, lower-cased. Text that is null
or has no letter is ``und`` with score 0. ``score`` is the posterior of the
predicted language under equal priors; ties go to the smaller language name.
If no labelled row exists every prediction is ``und``.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import give_back, materialise, process_cache, ship_by_value, shuffle_partitions, tokenizer_file

ship_by_value(__name__)

UNDEFINED = "und"
VOCAB_FILE = "piece_bpe_32k.model"
WORD = re.compile(r"[^\W\d_]+")
#: words up to this many characters use plain products; longer ones log space
SHORT = 24


def pieces(path: str) -> tuple[dict[str, int], int, int]:
    """Piece -> id of the vocabulary's ordinary pieces, the longest piece, and the id of byte piece 0."""
    key = ("pieces", path)
    cache = process_cache("langid")
    if key not in cache:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        ids = {sp.id_to_piece(i): i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        first = min(i for i in range(n) if sp.is_byte(i))
        cache[key] = (ids, max(map(len, ids)), first)
    return cache[key]


def lattice(word: str, ids: dict[str, int], longest: int, byte0: int) -> list[tuple[int, int, tuple[int, ...]]]:
    """Edges (from, to, piece ids) of all segmentations of a word, ordered by start."""
    s = "▁" + word
    n = len(s)
    edges = []
    for i in range(n):
        for j in range(i + 1, min(n, i + longest) + 1):
            k = ids.get(s[i:j])
            if k is not None:
                edges.append((i, j, (k,)))
            elif j == i + 1:
                edges.append((i, j, tuple(byte0 + b for b in s[i].encode("utf-8", "surrogatepass"))))
    return edges


def word_loglik(word: str, logp: np.ndarray, prob: list, ids: dict[str, int], longest: int, byte0: int) -> list[float]:
    """Forward algorithm: log P(word | language) for every language.

    ``prob[piece]`` is a list of probabilities by language, ``logp`` the same
    as a matrix of logarithms [piece, language].
    """
    n, langs = len(word) + 1, logp.shape[1]
    edges = lattice(word, ids, longest, byte0)
    if n <= SHORT:
        alpha = [[0.0] * langs for _ in range(n + 1)]
        alpha[0] = [1.0] * langs
        for i, j, ks in edges:
            a, b = alpha[i], alpha[j]
            if len(ks) == 1:
                p = prob[ks[0]]
                for x in range(langs):
                    b[x] += a[x] * p[x]
            else:
                q = [math.prod(prob[k][x] for k in ks) for x in range(langs)]
                for x in range(langs):
                    b[x] += a[x] * q[x]
        if min(alpha[n]) > 1e-290:
            return [math.log(v) for v in alpha[n]]
    la = np.full((n + 1, langs), -np.inf)
    la[0] = 0.0
    for i, j, ks in edges:
        la[j] = np.logaddexp(la[j], la[i] + logp[list(ks)].sum(axis=0))
    return la[n].tolist()


def expected_counts(rows: Iterator[tuple[int, str, int]], logp: np.ndarray, path: str) -> dict[tuple[int, int], float]:
    """E-step over (language, word, count): expected uses of each (language, piece)."""
    ids, longest, byte0 = pieces(path)
    logs = [logp[:, x].tolist() for x in range(logp.shape[1])]
    out: dict[tuple[int, int], float] = {}
    for lang, word, count in rows:
        n, lp = len(word) + 1, logs[lang]
        edges = [(i, j, ks, lp[ks[0]] if len(ks) == 1 else sum(lp[k] for k in ks)) for i, j, ks in lattice(word, ids, longest, byte0)]
        used = _linear(edges, n) if n <= SHORT else None
        for ks, e in used if used is not None else _logarithmic(edges, n):
            if e > 1e-9:
                for k in ks:
                    out[lang, k] = out.get((lang, k), 0.0) + count * e
    return out


def _linear(edges: list, n: int) -> list | None:
    """Forward-backward with products: (pieces, posterior) of each edge; None if it underflows."""
    fwd, bwd = [0.0] * (n + 1), [0.0] * (n + 1)
    fwd[0] = bwd[n] = 1.0
    weighed = [(i, j, ks, math.exp(w)) for i, j, ks, w in edges]
    for i, j, _, p in weighed:
        fwd[j] += fwd[i] * p
    if fwd[n] < 1e-290:
        return None
    for i, j, _, p in reversed(weighed):
        bwd[i] += bwd[j] * p
    return [(ks, fwd[i] * p * bwd[j] / fwd[n]) for i, j, ks, p in weighed]


def _logarithmic(edges: list, n: int) -> list:
    fwd, bwd = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
    fwd[0] = bwd[n] = 0.0
    for i, j, _, w in edges:
        fwd[j] = _logadd(fwd[j], fwd[i] + w)
    for i, j, _, w in reversed(edges):
        bwd[i] = _logadd(bwd[i], bwd[j] + w)
    return [(ks, math.exp(fwd[i] + w + bwd[j] - fwd[n])) for i, j, ks, w in edges]


def _logadd(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _word_counts(path: str):
    def run(batches):
        for b in batches:
            counts: Counter = Counter()
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                for w, c in Counter(WORD.findall(text.lower())).items():
                    counts[lang, w] += c
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                 pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])
    return run


class LanguageModel:
    """Languages and log piece probabilities [piece, language]."""

    def __init__(self, langs: list[str], logp: np.ndarray, path: str):
        self.langs, self.logp, self.path = langs, logp, path


def fit(docs: DataFrame, fit_rows: int = 1000, rounds: int = 3, smoothing: float = 0.05,
        vocab: str | None = None) -> LanguageModel:
    """Fit piece probabilities from ``text`` and non-null ``lang``.

    ``fit_rows`` bounds the labelled sample (expected rows over all languages,
    split evenly; chosen by a hash of the text, whole texts).
    """
    spark = docs.sparkSession
    path = vocab or tokenizer_file(VOCAB_FILE)
    labelled = docs.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != ""))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    ids, _, _ = pieces(path)
    v = max(ids.values()) + 1
    if not langs:
        return LanguageModel([], np.zeros((v, 0)), path)
    share = max(1, fit_rows // len(langs))
    keep: Column = F.lit(False)
    where = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    for lang in langs:
        keep = keep | ((F.col("lang") == lang) & (where < min(1.0, share / sizes[lang])))
    words = labelled.where(keep).mapInArrow(_word_counts(path), "lang string, word string, n long") \
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = materialise(words, "langid-words").repartition(max(12, shuffle_partitions(spark)), "word", "lang")
    number = {lang: i for i, lang in enumerate(langs)}
    logp = np.full((v, len(langs)), -math.log(v))
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(logp)  # vocabulary x languages

        def e_step(batches, model=model):
            def rows():
                for b in batches:
                    for lang, w, n in zip(*(b.column(c).to_pylist() for c in ("lang", "word", "n"))):
                        yield number[lang], w, n
            got = expected_counts(rows(), model.value, path)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in got], pa.int32()), pa.array([k[1] for k in got], pa.int32()),
                 pa.array(list(got.values()), pa.float64())], names=["lang", "piece", "e"])

        summed = words.mapInArrow(e_step, "lang int, piece int, e double").groupBy("lang", "piece").agg(F.sum("e").alias("e"))
        counts = np.full((v, len(langs)), smoothing)
        for r in summed.collect():
            counts[r["piece"], r["lang"]] += r["e"]
        logp = np.log(counts / counts.sum(axis=0))
    return LanguageModel(langs, logp, path)


class PieceTrie:
    """The vocabulary as sorted transitions (node, letter) -> node, walked for all words of a batch at once."""

    def __init__(self, ids: dict[str, int]):
        nodes: dict[str, int] = {"": 0}
        for piece in ids:
            for j in range(1, len(piece) + 1):
                nodes.setdefault(piece[:j], len(nodes))
        keys = np.array([nodes[s[:-1]] << 21 | ord(s[-1]) for s in nodes if s], np.int64)
        child = np.array([n for s, n in nodes.items() if s], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], child[order]
        self.piece = np.full(len(nodes), -1, np.int64)
        for piece, k in ids.items():
            self.piece[nodes[piece]] = k

    def step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Next node of each (node, letter); -1 where there is none or ``node`` is -1."""
        out = np.full(len(node), -1, np.int64)
        live = np.flatnonzero(node >= 0)
        key = node[live] << 21 | letter[live]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        out[live[hit]] = self.child[at[hit]]
        return out


def piece_trie(path: str) -> PieceTrie:
    cache = process_cache("langid")
    if ("trie", path) not in cache:
        cache["trie", path] = PieceTrie(pieces(path)[0])
    return cache["trie", path]


def batch_loglik(words: list[str], logp: np.ndarray, path: str) -> np.ndarray:
    """Forward algorithm over many words at once: log P(word | language) as [word, language].

    Words of one length share a table of nodes: the walk from every start finds
    all pieces, then each place adds up the segmentations that end there. Long
    words and those that would underflow take the logarithmic way.
    """
    ids, longest, byte0 = pieces(path)
    trie = piece_trie(path)
    out = np.empty((len(words), logp.shape[1]))
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w) + 1, []).append(k)
    prob = np.vstack([np.exp(logp), np.zeros(logp.shape[1])])  # the last row stands for "no piece"
    for n, at in by_length.items():
        # bounded tables: at most about half a million places at a time
        step = max(1, 500_000 // n)
        for part in ([at[i:i + step] for i in range(0, len(at), step)] if n <= SHORT else []):
            text = "".join("▁" + words[k] for k in part)
            letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64).reshape(len(part), n)
            out[part] = _forward(letters, trie, prob, longest, byte0)
        places = np.array(at)
        rest = at if n > SHORT else places[~np.isfinite(out[places]).all(axis=1)].tolist()
        linear = prob.tolist() if n <= SHORT and rest else []
        for k in rest:
            out[k] = word_loglik(words[k], logp, linear, ids, longest, byte0)
    return out


def _forward(letters: np.ndarray, trie: PieceTrie, prob: np.ndarray, longest: int, byte0: int) -> np.ndarray:
    m, n = letters.shape
    none = len(prob) - 1
    node = np.zeros(m * n, np.int64).reshape(m, n)
    alpha = np.zeros((n + 1, m, prob.shape[1]))
    alpha[0] = 1.0
    found = []  # found[l - 1][word, start]: piece of l letters
    for length in range(1, min(longest, n) + 1):
        starts = n - length + 1
        node = trie.step(node[:, :starts].ravel(), letters[:, length - 1:].ravel()).reshape(m, starts)
        if not (node >= 0).any() and length > 1:
            break
        found.append(np.where(node >= 0, trie.piece[node], -1))
    extra = prob
    bare = found[0] < 0
    if bare.any():  # letters outside the vocabulary: the product of their byte pieces
        unknown = np.unique(letters[bare])
        rows = [np.prod(prob[[byte0 + b for b in chr(c).encode("utf-8", "surrogatepass")]], axis=0) for c in unknown.tolist()]
        extra = np.vstack([prob, rows])
        found[0] = np.where(bare, none + 1 + np.searchsorted(unknown, letters), found[0])
    for j in range(1, n + 1):
        for length in range(1, min(len(found), j) + 1):
            piece = found[length - 1][:, j - length]
            if (piece >= 0).any():
                alpha[j] += alpha[j - length] * extra[np.where(piece < 0, none, piece)]
    last = alpha[n]
    with np.errstate(divide="ignore"):
        return np.where((last.min(axis=1) > 1e-290)[:, None], np.log(last), np.nan)


class _Scorer:
    """Memo of word scores in one Python worker: word -> row of a matrix [word, language]."""

    def __init__(self, logp: np.ndarray, path: str, limit: int = 120_000):
        self.logp, self.path, self.limit = logp, path, limit
        self.rows, self.at = np.zeros((0, logp.shape[1])), {}

    def texts(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Log-likelihoods by language (None: no letter)."""
        counted = [Counter(WORD.findall(t.lower())) if t else Counter() for t in texts]
        new = [w for w in set().union(*counted) if w not in self.at]
        if new:
            if len(self.at) + len(new) > self.limit:
                self.at, self.rows, new = {}, self.rows[:0], list(set().union(*counted))
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.rows = np.concatenate([self.rows, batch_loglik(new, self.logp, self.path)])
        out = []
        for words in counted:
            if not words or not any(any(map(str.isalpha, w)) for w in words):
                out.append(None)
            else:
                out.append(np.fromiter(words.values(), np.float64, len(words)) @ self.rows[[self.at[w] for w in words]])
        return out


def portions(texts: list[str | None], most: int = 400_000):
    """Neighbouring texts of together about ``most`` characters."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` appended (a narrow map, no shuffle).

    Only ``text`` is an input of the prediction. All other columns pass
    through; columns of these two names in the input are replaced.
    """
    rest = docs.drop("lang_pred", "score")
    if not model.langs:
        return rest.withColumns({"lang_pred": F.lit(UNDEFINED), "score": F.lit(0.0)})
    sc = docs.sparkSession.sparkContext
    shared, path, langs = sc.broadcast(model.logp), model.path, model.langs
    token = uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = process_cache("langid")
        if cache.get("token") != token:
            cache["token"], cache["scorer"] = token, _Scorer(shared.value, path)
        for texts in batches:
            pred, score = [], []
            for part in portions(texts.tolist()):
                for ll in cache["scorer"].texts(part):
                    k = -1 if ll is None else int(ll.argmax())
                    pred.append(UNDEFINED if ll is None else langs[k])
                    score.append(0.0 if ll is None else float(1.0 / np.exp(np.maximum(ll - ll[k], -700.0)).sum()))
            yield pd.DataFrame({"lang_pred": pred, "score": score})
        give_back()

    # only the text goes to Python and only the two results come back
    return rest.withColumn("_scored", scored(F.col("text"))).select(*rest.columns, "_scored.lang_pred", "_scored.score")


def held_out(doc_id: str = "doc_id") -> Column:
    """The fixed fold: crc32 of the id's text, remainder 2 by 4 (a null id is never held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
