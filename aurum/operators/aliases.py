"""Aliases of surrogate keys (CK-02).

A source without a national id names a customer by a hash of mutable fields, so a new last name or phone gives a new
key, and feeds that still carry the old one lose their customer. Two surrogate keys of a system are aliases when they
agree in the first name and in the phone or the e-mail; aliases of aliases are aliases. Agreement is an equality of a
key, so it is a group of :mod:`aurum.operators.graph` (a star, never its pairs) and the classes are its components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.operators import graph
from aurum.operators.survivorship import desc_date
from aurum.session import written


def alias_classes(contacts: DataFrame) -> DataFrame:
    """contacts(source_system, source_key, first_name, phone, email) of surrogate keys, a row for each state of a
    record -> (source_system, source_key, alias_id). A key without a partner is alone; nulls and blanks agree with nothing."""
    c = contacts.select("source_system", "source_key", F.to_json(F.struct("source_system", "source_key")).alias("node"),
                        F.lower(F.trim("first_name")).alias("first"), "phone", "email")
    evidence = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(n).alias("value")) for n in ("phone", "email")]))
    members = (c.where(F.length("first") > 0).select("node", "source_system", "first", evidence.alias("e"))
               .where(F.length(F.trim("e.value")) > 0)
               .select("node", F.to_json(F.struct("source_system", "first", "e.kind", "e.value")).alias("gid")))
    classes = graph.connected_components(c.select("node"), graph.star_edges(members))
    return c.select("source_system", "source_key", "node").distinct().join(classes, "node") \
        .select("source_system", "source_key", F.col("component").alias("alias_id"))


def address_links(addr: DataFrame, classes: DataFrame) -> DataFrame:
    """(source_system, source_key, owner_key): for every key without an address the alias that has the newest one
    (ties: the smaller key). One row for each such key, so rows follow the keys of a class, not their pairs."""
    newest = addr.groupBy("source_system", F.col("source_customer_key").alias("source_key")).agg(F.max("file_date").alias("newest"),
                                                                                                 F.lit(True).alias("has"))
    known = classes.join(newest.hint("merge"), ["source_system", "source_key"], "left")
    # a written table on this side lets AQE split the join where one class is hot
    owners = written(known.where("has").groupBy("source_system", "alias_id")
                     .agg(F.min_by("source_key", F.struct(desc_date("newest"), F.col("source_key"))).alias("owner_key")))
    return known.where("has IS NULL").join(owners, ["source_system", "alias_id"]).select("source_system", "source_key", "owner_key")


def link_addresses(addr: DataFrame, links: DataFrame) -> DataFrame:
    """``addr`` and, under the key of each link, the addresses of its owner."""
    copies = addr.join(links.select("source_system", F.col("owner_key").alias("source_customer_key"), F.col("source_key").alias("_alias")).hint("merge"),
                       ["source_system", "source_customer_key"]) \
        .withColumn("source_customer_key", F.col("_alias")).select(*addr.columns)
    return addr.unionByName(copies)
