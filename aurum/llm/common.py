"""Helpers shared by the operators: table access, shared scratch tables, row keys."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.session import ensure_checkpoint_dir


def ship_by_value(module_name: str) -> None:
    """Pickle the functions of a module by value, so that executors need no install of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship_by_value(__name__)


def process_cache(owner: str) -> dict:
    """A dict that lives as long as the Python worker: an operator's loaded vocabularies and memo tables.

    A worker serves one operator after another; what the last one kept is dropped.
    """
    held = sys.__dict__.setdefault("_aurum_llm_cache", {})
    if owner not in held:
        held.clear()
        held[owner] = {}
    return held[owner]


def give_back() -> None:
    """Return a task's freed memory to the system, so that idle workers stay small beside a full JVM heap."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run, keep: str | None = None):
    """``run`` (batches -> batches), which drops what operators remember and frees memory at the end of a task.

    ``keep`` names an operator whose loaded vocabulary stays for the next task.
    """
    def wrapped(batches):
        yield from run(batches)
        if keep is None:
            sys.__dict__.setdefault("_aurum_llm_cache", {}).clear()
        else:
            process_cache(keep)
        give_back()
    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    This cuts the lineage at a reliable copy: a lost executor never makes an
    upstream stage run again, and several consumers read one result. A join
    with the written table is one of two plain exchanges, so adaptive execution
    can split it where a key of the other side holds a large part of all rows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def text_key(col: str = "text") -> dict[str, Column]:
    """128 bits of hash of a text in two columns, ``k1`` and ``k2``: the key of its rows between stages."""
    full = text_or_empty(col)
    return {"k1": F.xxhash64(full), "k2": F.xxhash64(F.lit(1), full)}


def sha_hex(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file (never copied into the repository)."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def merge_spans(spans: Column) -> Column:
    """Sorted, disjoint (start, end) of an array of structs with ``start`` and ``end``."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return F.aggregate(ordered, none, lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["end"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1),
                 F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(s))))


def replace_spans(text: Column, spans: Column, with_: str) -> Column:
    """``text`` with each of the (merged) spans replaced by ``with_``. Offsets are code points from 0."""
    merged = merge_spans(spans)
    starts = F.concat(F.array(F.lit(0)), F.transform(merged, lambda s: s["end"]))
    ends = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length(text)))
    kept = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: text.substr(p["a"] + F.lit(1), p["b"] - p["a"]))
    return F.array_join(kept, with_)
