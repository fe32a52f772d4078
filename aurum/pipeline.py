"""From source files to golden records: the public entry of the pairwise and SSN-first rule sets.

    sources = read_sources(spark, "s3a://bucket/landing")
    result = run(sources, as_of="2024-06-01 00:00:00")
    result["golden"].write.parquet(...)

The landing folder holds ``initial/`` and ``update/`` with files ``YYYY-MM-DD_crm_<source>_customers.csv`` and
``..._addresses.csv`` (or folders of that name with part files). Own DataFrames with the columns of :data:`SCHEMAS` and
``_source_file`` do as well: build a :class:`Sources` of them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.operators import aliases, serving
from aurum.operators.harmonise import enrich_v2, union_addresses, union_customers_v2
from aurum.plans import pairwise, ssn_first
from aurum.session import ensure_checkpoint_dir, written
from aurum.sources.files import read_source_csv


def _schema(names: str, required: tuple[str, ...] = ()) -> T.StructType:
    """Columns of a file in order; names that end in ``_date`` are dates."""
    return T.StructType([T.StructField(n, T.DateType() if n.endswith("_date") else T.StringType(), n not in required)
                         for n in names.split()])


_CONTACT = "ssn first_name last_name phone email record_date organization"
CUSTOMER_SCHEMAS = {
    "freg": _schema("ssn first_name last_name birth_date citizenship record_date", ("ssn",)),
    "bs": _schema(_CONTACT, ("ssn",)),
    "nice": _schema(_CONTACT),
}
ADDRESS_SCHEMA = _schema("src_address_id src_customer_id gate postnummer by land", ("src_address_id", "src_customer_id"))
SCHEMAS = CUSTOMER_SCHEMAS | {f"addr_{x}": ADDRESS_SCHEMA for x in CUSTOMER_SCHEMAS}
NULL_TOKENS = {"freg": ("", "NULL", "null"), "bs": ("", "NULL", "null"), "nice": ("", "NULL", "null", "N/A")}
LINEAGE = r"(initial|update)/(?:[^/=]+=)?([^/=]+_crm_[a-z]+_[a-z]+\.csv)"


@dataclass
class Sources:
    """The three customer feeds; addresses and steward overrides (source_key_a, source_key_b) may be absent."""

    freg: DataFrame
    bs: DataFrame
    nice: DataFrame
    addresses: dict[str, DataFrame] = field(default_factory=dict)
    overrides: DataFrame | None = None
    rejects: DataFrame | None = None  # source, _rejects, _source_path of the records that couldn't be loaded


def read_sources(spark: SparkSession, root: str, overrides: DataFrame | None = None, addresses: bool = True) -> Sources:
    """Typed feeds of a landing folder. A feed without any file is an error of the read; bad records go to ``rejects``."""
    feeds, rejects = {}, None
    for name, schema in SCHEMAS.items():
        kind, source = ("addresses", name[5:]) if name.startswith("addr_") else ("customers", name)
        if kind == "addresses" and not addresses:
            continue
        rows, bad = read_source_csv(spark, f"{root}/*/*_crm_{source}_{kind}.csv", schema, NULL_TOKENS[source])
        path = F.col("_source_path")
        feeds[name] = rows.withColumn("_source_file", F.concat_ws("/", F.regexp_extract(path, LINEAGE, 1), F.regexp_extract(path, LINEAGE, 2))) \
            .drop("_source_path")
        bad = bad.select(F.lit(name).alias("source"), "_rejects", "_source_path")
        rejects = bad if rejects is None else rejects.unionByName(bad)
    return Sources(feeds["freg"], feeds["bs"], feeds["nice"],
                   {x: feeds[f"addr_{x}"] for x in CUSTOMER_SCHEMAS if f"addr_{x}" in feeds}, overrides, rejects)


def run(sources: Sources, blocks: str = "extended", mode: str = "transitive", canonical: str = "initcap",
        as_of: str | Column | None = None) -> dict[str, DataFrame]:
    """Pairwise rule set over ``sources``: the layers by name, from ``enriched`` to ``customer_360``.

    ``as_of`` is the processing time that golden records carry (default: now), so a repeated run can give equal rows.
    Enriched rows, clusters, addresses and their alias links are checkpointed; the other layers are plans over them. Without addresses the address
    layers are left out. Empty feeds give empty layers.
    """
    spark = sources.freg.sparkSession
    ensure_checkpoint_dir(spark)
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    enriched = written(enrich_v2(union_customers_v2(sources.freg, sources.bs, sources.nice), canonical))
    clusters = written(pairwise.clusters(pairwise.MatchGraph(enriched, blocks, sources.overrides), mode))
    golden = pairwise.golden(enriched, clusters)
    out = {
        "enriched": enriched,
        "clusters": clusters,
        "golden": golden.select(*pairwise.GOLDEN_OUT, "dq_fired_rules", now.alias("mdm_processed_date")),
        "history": pairwise.history(enriched, clusters),
        "steward_queue": clusters.where("match_status = 'STEWARD_QUEUE'").join(enriched, ["source_system", "source_key", "organization"]),
        "xref": clusters.select("cluster_id", "organization", "source_system", "source_key"),
        "cross_org": serving.cross_org(golden),
    }
    if len(sources.addresses) == len(CUSTOMER_SCHEMAS):
        # read once: files would be parsed for the newest addresses, the links and the layers each
        addr = written(union_addresses(*[sources.addresses[x] for x in CUSTOMER_SCHEMAS]))
        classes = aliases.alias_classes(enriched.where(F.col("ssn").isNull()))
        addr = aliases.link_addresses(addr, written(aliases.address_links(addr, classes)))
        out["address_golden"] = pairwise.address_golden(addr, clusters)
        out["address_history"] = pairwise.address_history(addr, clusters)
        out["customer_360"] = serving.customer_360(golden, out["address_golden"])
    return out


def run_ssn_first(sources: Sources) -> dict[str, DataFrame]:
    """SSN-first rule set over ``sources``: match groups, golden records, current state, history, steward queue."""
    from aurum.operators.harmonise import enrich_v1, union_customers_v1
    ensure_checkpoint_dir(sources.freg.sparkSession)
    groups = ssn_first.groups(enrich_v1(union_customers_v1(sources.freg, sources.bs, sources.nice, True)).checkpoint()).checkpoint()
    golden = ssn_first.golden(groups)
    return {"groups": groups, "golden": golden, "current": ssn_first.current(golden), "history": ssn_first.history(groups),
            "steward_queue": ssn_first.steward_queue(groups)}
