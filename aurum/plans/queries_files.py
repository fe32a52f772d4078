"""The public pipeline from CSV files (SRC-01..05 to GD-02, GD-05): the derived feeds are written as source files and
read back, and the results are those of the pipelines over the feeds."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aurum import pipeline
from aurum.plans import inputs, pairwise
from aurum.plans.catalog import register
from aurum.plans.layers import layer
from aurum.session import shared_dir


def landing_files(spark, sf_dir: str) -> str:
    """initial/ and update/ with a folder of part files in place of each CSV file."""
    root = shared_dir(spark, f"source_files/{uuid.uuid4().hex[:8]}")
    for name, schema in pipeline.SCHEMAS.items():
        feed = inputs.table(spark, sf_dir, name)
        parts = F.split("_source_file", "/")
        cols = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias(c) for c in schema.fieldNames()]
        out = feed.select(*cols, parts[0].alias("phase"), parts[1].alias("file")).repartition("phase", "file")
        for phase in ("initial", "update"):
            out.where(F.col("phase") == phase).drop("phase").write.partitionBy("file").option("header", True).mode("append").csv(f"{root}/{phase}")
    return root


def _result(spark, sf_dir: str, name: str):
    """A layer of one run from files; both queries share it."""
    result: dict = {}

    def build(n):
        if not result:
            sources = pipeline.read_sources(spark, landing_files(spark, sf_dir), inputs.overrides(spark, sf_dir))
            result.update(pipeline.run(sources, blocks="parity", as_of="2024-06-01 00:00:00"))
        return result[n]
    return {n: layer(spark, ("files", sf_dir, n), lambda n=n: build(n)) for n in ("golden", "address_golden")}[name]


@register("files_golden", pairwise.GOLD_SQL + f"""
SELECT {', '.join(pairwise.GOLDEN_OUT)}, TIMESTAMP '2024-06-01 00:00:00' AS mdm_processed_date FROM v2_golden""", "SRC-01, SRC-03, SRC-05, GD-02")
def q_files_golden(spark, sf_dir):
    return _result(spark, sf_dir, "golden").drop("dq_fired_rules")


@register("files_address_golden", pairwise.V2_SQL + "\nSELECT * FROM a2_golden", "SRC-01, SRC-03, SRC-05, GD-05")
def q_files_address_golden(spark, sf_dir):
    return _result(spark, sf_dir, "address_golden")
