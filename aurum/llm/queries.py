"""The queries of the operators: ``opN_<name>`` and ``pipeline``.

Each query reads its whole table, applies its operator with production
parameters and derives the columns that its contract names. ``SQL`` holds the
same result in DuckDB SQL where SQL can express it; the other operators are
tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.llm import decontam, html_extract, langid, lloyd, neardup, packing, pii, ppm, secrets, substring, token_counts, topk, whitening
from aurum.llm.common import sha_hex, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.fit(docs.where(~F.col("held_out")))
    return langid.predict(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract_pages(pages.select("page_id", "url", "html"), html_extract.fit(pages))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.report(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
                        sha_hex(pii.describe(F.col("base"))).alias("base_sha256"), pii.describe(F.col("spans")).alias("spans"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", sha_hex(F.col("kept")).alias("kept_sha256"))


@query
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.integer_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", decontam.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        sha_hex(ids).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs)).drop("text")
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), sha_hex(_spans(base)).alias("base_sha256"), _spans(F.col("secrets")).alias("spans"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = lloyd.compress(table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", lloyd.hex_code(F.col("code")).alias("code"), "error", "label_error", F.lit(lloyd.books_digest(books)).alias("codebooks_sha256"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", ppm.held_out().alias("held_out"))
    return ppm.score(docs, ~F.col("held_out")).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


SQL["op6_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
rep AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win SEMI JOIN rep USING (s)),
m AS (SELECT p.doc_id, p.i, p.word,
             max(hit.i) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
      FROM p LEFT JOIN hit ON hit.doc_id = p.doc_id AND hit.i = p.i),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

SQL["op7_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

SQL["op8_decontaminate"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, n FROM dw JOIN iw USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""


def lloyd_sql(rounds: int = 4) -> str:
    """Lloyd's rounds by a full scan: every part meets every entry of its codebook."""
    near = "arg_min(c.j, {'d': list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.c) + list_inner_product(c.c, c.c), 'j': c.j})"
    least = "min(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, c.c) + list_inner_product(c.c, c.c))"
    sql = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS x FROM v, (SELECT unnest(range(4)) AS part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS j, x AS c FROM p WHERE r <= 256)"""
    for k in range(rounds):
        sql += f""",
a{k} AS MATERIALIZED (SELECT p.r, p.part, {near} AS j FROM p JOIN c{k} c USING (part) GROUP BY p.r, p.part),
m{k} AS (SELECT part, j, list(s ORDER BY i) AS c FROM (
  SELECT part, j, i, floor(sum(y) / count(*)) AS s FROM (SELECT a.part, a.j, unnest(p.x) AS y, unnest(range(len(p.x))) AS i FROM a{k} a JOIN p USING (r, part)) GROUP BY ALL) GROUP BY part, j),
c{k + 1} AS MATERIALIZED (SELECT c.part, c.j, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m USING (part, j))"""
    return sql + f""",
f AS MATERIALIZED (SELECT p.r, p.part, {near} AS j, {least} AS d FROM p JOIN c{rounds} c USING (part) GROUP BY p.r, p.part),
e AS (SELECT r, string_agg(printf('%02x', j), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY r),
h AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY part, j, i)) AS codebooks_sha256
      FROM (SELECT part, j, unnest(c) AS y, unnest(range(len(c))) AS i FROM c{rounds}))
SELECT v.vec_id, e.code, e.error, CAST(sum(e.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, h.codebooks_sha256
FROM v JOIN e USING (r), h"""


SQL["op11_vector_codes"] = lloyd_sql()
