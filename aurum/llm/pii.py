"""Personal data: fixed patterns, extended by bootstrapped contextual extraction.

Everything here is DataFrame and SQL expressions.

Base spans of four kinds come from fixed patterns with a check each. They are
the seeds: the words before a seed are lexical patterns, the seed's string is
an instance. A second, loose pattern takes every token that holds a digit or an
``@`` as a further instance if its shape could be of a kind. Patterns and
instances form a bipartite graph by kind, and Spark scores it in rounds:

* a pattern's confidence is the mean score of its instances (seeds score 1,
  unknown instances what the last round gave them) and needs ``support`` seeds;
* an unknown instance scores 1 - prod(1 - confidence) over its patterns (noisy
  or), patterns under ``least`` left out.

After the last round, unknown instances that score ``least`` or more are
reported, where they stand behind a pattern of that confidence, under the
kind's name. Only mentions (a key, a place and a few words of context) shuffle
for that, never the texts.

Semantics: null text is empty. Offsets are code points, ends exclusive; base
matches of a kind are leftmost and do not overlap, a match that fails its
check is dropped without another try. Rows of the same text share their result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import materialise, replace_spans, text_key, text_or_empty

# The contract's patterns, written so that Java's matcher works in linear time and constant stack: possessive runs,
# and starts only where a run of the class starts or the last match ended.
KINDS = ("email", "ip", "card", "phone")
MATCH = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # maximal runs of digits with single separators; those of fewer than 13 digits fail the check anyway
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[0-9]|[\x20-][0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: loose instances: white-space separated tokens with a digit or @, without the punctuation around them
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
EDGE = r"^[\"'(\[<{,;:]+|[\"')\]>},;:.!?]+$"
#: what an unknown instance of a kind must look like
SHAPE = {
    "email": r"^[^@\s]+@[^@\s]+$",
    "ip": r"^[0-9]{1,4}(?:[.:][0-9]{1,4}){2,7}$",
    "card": r"^(?:[0-9]-?){11,18}[0-9]$",
    "phone": r"^\(?[0-9](?:[().-]{0,2}[0-9]){6,14}$",
}
MENTION = "array<struct<start:int,end:int,word:string,before:string>>"


def located(text: Column, pattern: str) -> Column:
    """Matches of a pattern with code-point offsets and the 64 characters before each.

    The text is split at the matches; lengths of gaps and matches add up to offsets.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.struct(F.lit(0).alias("at"), F.array().cast(MENTION).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["word"])
        one = F.struct(start.alias("start"), end.alias("end"), x["word"].alias("word"), F.right(x["gap"], F.lit(64)).alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("word"))
    return F.aggregate(pairs, none, step, lambda acc: acc["out"])


def luhn(digits: Column) -> Column:
    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def valid(kind: str, word: Column) -> Column:
    if kind == "ip":
        return word.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(word, r"[\x20-]", "")
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(word, r"[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _checked(kind: str):
    return lambda m: valid(kind, m["word"])


def _span(kind: int):
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))


def base_mentions(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``k1``, ``k2`` and one array of mentions for each kind and for loose tokens (a narrow map)."""
    full = text_or_empty(text)
    out = docs.withColumns(text_key(text) | {"_t": full})
    # texts without the characters that a pattern needs are not searched
    worth = {"email": F.col("_t").contains("@"), "phone": F.col("_t").contains("+")}
    digit = F.col("_t").rlike("[0-9]")
    empty = F.array().cast(MENTION)
    out = out.withColumn("_digit", digit)
    for kind in KINDS:
        hits = F.filter(located(F.col("_t"), MATCH[kind]), _checked(kind))
        out = out.withColumn(kind, F.when(worth.get(kind, F.col("_digit")), hits).otherwise(empty))
    loose = F.when(F.col("_digit") | worth["email"], located(F.col("_t"), TOKEN)).otherwise(empty)
    return out.withColumn("loose", loose).drop("_t", "_digit")


def _patterns(before: Column) -> Column:
    """The last word and the last two words before a mention, lower-cased, within its line's last 64 characters."""
    tail = F.lower(F.trim(F.regexp_replace(F.element_at(F.split(before, "\n"), -1), r"\s+", " ")))
    one = F.substring_index(tail, " ", -1)
    two = F.substring_index(tail, " ", -2)
    return F.filter(F.array(F.concat(F.lit("1:"), one), F.when(two != one, F.concat(F.lit("2:"), two))), lambda p: p.isNotNull() & (F.length(p) > 2))


def _edges(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seeds (kind, pattern, instance) and unknown mentions (k1, k2, kind, pattern, instance, start, end)."""
    seeds = None
    for kind in KINDS:
        s = found.where(F.size(kind) > 0).select(F.explode(kind).alias("m")).select(
            F.lit(kind).alias("kind"), F.explode(_patterns(F.col("m.before"))).alias("pattern"), F.lower("m.word").alias("instance"))
        seeds = s if seeds is None else seeds.unionByName(s)
    taken = F.concat(*[F.transform(k, lambda m: F.struct(m["start"], m["end"])) for k in KINDS])
    loose = found.where(F.size("loose") > 0).select("k1", "k2", taken.alias("taken"), F.explode("loose").alias("m"))
    loose = loose.where(~F.exists("taken", lambda s: (s["start"] < F.col("m.end")) & (F.col("m.start") < s["end"])))
    word = F.regexp_replace("m.word", EDGE, "")
    lead = F.length("m.word") - F.length(F.regexp_replace("m.word", r"^[\"'(\[<{,;:]+", ""))
    loose = loose.select("k1", "k2", word.alias("word"), (F.col("m.start") + lead).alias("start"), _patterns(F.col("m.before")).alias("patterns"))
    unknown = None
    for kind in KINDS:
        u = loose.where(F.col("word").rlike(SHAPE[kind])).select(
            "k1", "k2", F.lit(kind).alias("kind"), F.explode("patterns").alias("pattern"), F.lower("word").alias("instance"),
            "start", (F.col("start") + F.length("word")).alias("end"))
        unknown = u if unknown is None else unknown.unionByName(u)
    return seeds, unknown


def bootstrap(found: DataFrame, rounds: int = 3, least: float = 0.8, support: int = 3) -> DataFrame:
    """Spans (k1, k2, kind, start, end) of unknown instances that the scored graph accepts."""
    seeds, unknown = _edges(found)
    seeds = seeds.groupBy("kind", "pattern").agg(F.countDistinct("instance").alias("seeds"))
    mentions = materialise(unknown, "pii-mentions")
    edges = mentions.select("kind", "pattern", "instance").distinct()
    # only patterns with enough seeds can ever be trusted
    seeds = materialise(seeds.where(F.col("seeds") >= support), "pii-seeds")
    edges = materialise(edges.join(seeds.select("kind", "pattern"), ["kind", "pattern"], "left_semi"), "pii-edges")
    scores = edges.select("kind", "instance").distinct().withColumn("score", F.lit(0.0))
    trusted = None
    for r in range(rounds):
        mean = edges.join(scores, ["kind", "instance"]).groupBy("kind", "pattern").agg(F.sum("score").alias("s"), F.count("*").alias("n"))
        trusted = seeds.join(mean, ["kind", "pattern"]).withColumn("confidence", (F.col("seeds") + F.col("s")) / (F.col("seeds") + F.col("n"))) \
            .where(F.col("confidence") >= least).select("kind", "pattern", "confidence")
        scores = edges.join(trusted, ["kind", "pattern"]).groupBy("kind", "instance") \
            .agg((1.0 - F.product(1.0 - F.col("confidence"))).alias("score"))
        scores = materialise(edges.select("kind", "instance").distinct().join(scores, ["kind", "instance"], "left")
                             .select("kind", "instance", F.coalesce("score", F.lit(0.0)).alias("score")), "pii-scores")
    accepted = scores.where(F.col("score") >= least).select("kind", "instance")
    return mentions.join(trusted.select("kind", "pattern"), ["kind", "pattern"], "left_semi") \
        .join(accepted, ["kind", "instance"], "left_semi").select("k1", "k2", "kind", "start", "end").distinct()


SPAN = "array<struct<kind:int,start:int,end:int>>"


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **bootstrapping) -> DataFrame:
    """(k1, k2, base, spans) by distinct text that has any: arrays of (kind number, start, end), ordered by kind, then start."""
    found = materialise(base_mentions(docs.select(text), text).drop(text).where(F.size("email") + F.size("ip") + F.size("card") + F.size("phone") + F.size("loose") > 0)
                        .dropDuplicates(["k1", "k2"]), "pii-found")
    base = F.concat(*[F.transform(k, _span(i)) for i, k in enumerate(KINDS)])
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    more = bootstrap(found, **bootstrapping).groupBy("k1", "k2").agg(F.collect_set(F.struct(number.alias("kind"), "start", "end")).alias("more"))
    both = found.select("k1", "k2", base.alias("base")).join(more, ["k1", "k2"], "left")
    spans = F.array_sort(F.concat("base", F.coalesce(F.col("more").cast(SPAN), F.array().cast(SPAN))))
    both = both.select("k1", "k2", F.col("base").cast(SPAN).alias("base"), spans.cast(SPAN).alias("spans")).where(F.size("spans") > 0)
    return materialise(both, "pii-spans")


def describe(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def report(docs: DataFrame, text: str = "text", **bootstrapping) -> DataFrame:
    """``docs`` without its text, with ``base`` and ``spans`` (empty arrays where there is nothing)."""
    found = find(docs, text, **bootstrapping).withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    keyed = docs.drop("base", "spans").withColumns({"_" + n: c for n, c in text_key(text).items()}).drop(text)
    none = F.array().cast(SPAN)
    return keyed.join(found, ["_k1", "_k2"], "left").drop("_k1", "_k2").withColumns({"base": F.coalesce("base", none), "spans": F.coalesce("spans", none)})


def mask(docs: DataFrame, text: str = "text", with_: str = "[PII]", **bootstrapping) -> DataFrame:
    """``docs`` with every span replaced in its text (overlapping spans once). Null texts stay null."""
    found = find(docs, text, **bootstrapping).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("spans").alias("_spans"))
    keyed = docs.withColumns({"_" + n: c for n, c in text_key(text).items()})
    hit = F.col("_spans").isNotNull() & F.col(text).isNotNull()
    # the spans grow with the corpus, so texts meet them by a sort-merge join at every size
    out = keyed.join(found.hint("merge"), ["_k1", "_k2"], "left")
    return out.withColumn(text, F.when(hit, replace_spans(F.col(text), F.col("_spans"), with_)).otherwise(F.col(text))).select(docs.columns)
