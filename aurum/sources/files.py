"""File sources and sinks: CSV with several NULL tokens, typed positional load with rejects,
lineage file name/date, incremental (new-files-only) ingestion (SRC-01..05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

DEFAULT_NULLS = ("", "NULL", "null")
MALFORMED = "_malformed_line"
REJECT_TYPE = "array<struct<field:string,reason:string,value:string>>"


def _nullify(c: Column, tokens) -> Column:
    return F.when(c.isin(*[t for t in tokens if t != ""]) | (F.length(c) == 0), F.lit(None)).otherwise(c)


def _csv(reader, schema: T.StructType, path: str, header: bool) -> DataFrame:
    """Every field as a string, plus the whole line of a record with too few or too many fields.

    The parser counts the fields of a line only if it reads all of them, so columns aren't pruned inside it: which
    records are malformed must not depend on the columns that a query selects.
    """
    strings = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                           + [T.StructField(MALFORMED, T.StringType())])
    return (reader.option("header", header).option("quote", '"').option("encoding", "UTF-8").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).schema(strings).csv(path))


def _reject(field: str | None, reason: str, value: Column) -> Column:
    return F.struct(F.lit(field).cast("string").alias("field"), F.lit(reason).alias("reason"), value.cast("string").alias("value"))


def type_rows(raw: DataFrame, schema: T.StructType, null_tokens=DEFAULT_NULLS, with_lineage: bool = True) -> DataFrame:
    """Typed columns and ``_rejects``: why a record can't be loaded, empty for an accepted one.

    Reasons are ``columns`` (the record has another number of fields; the value is its line), ``type`` (the value can't
    be cast) and ``missing`` (NULL or a NULL token in a field that the schema declares not nullable). A rejected record
    keeps the fields that can be typed. One projection: no shuffle, no second read.
    """
    cols, why = [], [F.when(F.col(MALFORMED).isNotNull(), _reject(None, "columns", F.col(MALFORMED)))]
    for f in schema.fields:
        text = _nullify(F.col(f.name), null_tokens)
        value = text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)
        cols.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            why.append(F.when(text.isNotNull() & value.isNull(), _reject(f.name, "type", F.col(f.name))))
        if not f.nullable:
            why.append(F.when(text.isNull(), _reject(f.name, "missing", F.col(f.name))))
    if with_lineage:
        cols.append(F.col("_metadata.file_path").alias("_source_path"))
    return raw.select(*cols, F.array_compact(F.array(*why)).cast(REJECT_TYPE).alias("_rejects"))


def read_source_csv(spark: SparkSession, path: str, schema: T.StructType, null_tokens=DEFAULT_NULLS,
                    with_lineage: bool = True, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """CSV files as (rows, rejects); optional quotes, UTF-8, every token in ``null_tokens`` -> NULL.

    A bad record never fails the load: it goes to the rejects frame with its reasons (:func:`type_rows`).
    """
    typed = type_rows(_csv(spark.read, schema, path, header), schema, null_tokens, with_lineage)
    ok = F.size("_rejects") == 0
    return typed.where(ok).drop("_rejects"), typed.where(~ok)


def lineage_columns(df: DataFrame, path_col: str = "_source_path") -> DataFrame:
    """File name and business file date from the lineage path (SRC-03)."""
    name = F.regexp_extract(F.col(path_col), r"([^/]+)$", 1)
    return df.withColumn("_file_name", name).withColumn(
        "_file_date", F.to_date(F.regexp_extract(F.col(path_col), r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd"))


def ingest_stream(spark: SparkSession, in_dir: str, schema: T.StructType, table_dir: str, checkpoint: str,
                  null_tokens=DEFAULT_NULLS, max_files: int | None = None, header: bool = True) -> StreamingQuery:
    """New files only, appended to a Parquet table, restartable from its checkpoint (SRC-02).

    Accepted records and rejects are two partitions of one table, so that one entry of the sink's log commits both:
    a batch that dies leaves neither, and a replayed batch adds neither twice. Read them with :func:`read_ingested`.
    ``trigger(availableNow)`` processes what is there and stops.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    typed = type_rows(_csv(reader, schema, in_dir, header), schema, null_tokens)
    out = typed.withColumn("_rejected", (F.size("_rejects") > 0).cast("int"))
    return (out.writeStream.format("parquet").option("path", table_dir).option("checkpointLocation", checkpoint)
            .partitionBy("_rejected").trigger(availableNow=True).start())


def read_ingested(spark: SparkSession, table_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a table written by :func:`ingest_stream`; each side reads its own partition."""
    table = spark.read.parquet(table_dir)
    return (table.where("_rejected = 0").drop("_rejected", "_rejects"),
            table.where("_rejected = 1").drop("_rejected"))
