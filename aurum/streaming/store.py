"""Keyed state as a delta log under a commit manifest (RT-01, RT-02, RT-04).

A table is a base and the deltas since then; a delta holds the rows that a batch
changed (``_gone`` marks removed keys), so what a batch writes follows the batch.
Once the deltas hold half as many rows as the base they are folded into a new
one, which spreads that cost over the rows changed since the last.

A batch writes into folders that carry its id and attempt. Nothing of it is seen
until its manifest, which names the folders of every table, appears by one
rename. A batch that died between two tables is run again as if it had never
been; its folders are removed with those that no manifest names any more (the
last two manifests are kept, so a reader of the version before can finish).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: keys of the state tables; all other tables are logs
KEYS = {"clusters": ["source_system", "source_key"], "golden": ["cluster_id"], "addresses": ["source_system", "source_key"], "address_golden": ["cluster_id"]}


class StateStore:
    """State tables and logs under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- files
    def _names(self, folder: str) -> list[str]:
        p = self._path(f"{self.root}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    def folders(self, table: str) -> list[str]:
        """Folders that a table has on disk, named by batch and attempt."""
        return sorted(self._names(table))

    def _manifest_file(self, batch: int) -> str:
        return f"{self.root}/_manifest/{batch:012d}.json"

    def manifest(self, batch: int) -> dict | None:
        p = self._path(self._manifest_file(batch))
        if batch < 0 or not self._fs.exists(p):
            return None
        stream = self._fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def committed(self) -> int:
        """Number of the last committed batch, -1 if there is none."""
        return max((int(n[:-5]) for n in self._names("_manifest") if n.endswith(".json")), default=-1)

    # -- tables
    def _load(self, table: str, folder: str, schema: str) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.root}/{table}/{folder}")

    def fold(self, table: str, entry: dict | None) -> DataFrame | None:
        """Current rows of a state table."""
        if entry is None:
            return None
        base = self._load(table, entry["base"][0], entry["schema"]).drop("_gone")
        if not entry["deltas"]:
            return base
        keys = KEYS[table]
        parts = None
        for seq, (folder, _) in enumerate(entry["deltas"]):
            one = self._load(table, folder, entry["schema"]).withColumn("_seq", F.lit(seq))
            parts = one if parts is None else parts.unionByName(one)
        rest = [c for c in base.columns if c not in keys]
        last = parts.groupBy(*keys).agg(F.max_by(F.struct(*rest, "_gone"), "_seq").alias("s"))
        kept = last.where(~F.col("s._gone")).select(*keys, *[F.col("s")[c].alias(c) for c in rest])
        return base.join(last.select(*keys), keys, "left_anti").unionByName(kept)

    def read(self, table: str, version: int) -> DataFrame | None:
        found = self.manifest(version)
        return self.fold(table, found["state"].get(table)) if found else None

    def table(self, name: str) -> DataFrame:
        """All committed batches of a log, with their ``batch_id``."""
        out = None
        for batch in range(self.committed() + 1):
            found = self.manifest(batch)
            if found and name in found["logs"]:
                one = self._load(name, *found["logs"][name]).withColumn("batch_id", F.lit(batch))
                out = one if out is None else out.unionByName(one)
        if out is None:
            raise LookupError(f"no committed batch wrote {name}")
        return out

    def begin(self, batch: int) -> Batch:
        return Batch(self, batch)


class Batch:
    """The writes of one batch, invisible until :meth:`commit`."""

    def __init__(self, store: StateStore, batch: int):
        self.store, self.batch = store, batch
        before = store.manifest(store.committed())
        self.state: dict = before["state"] if before else {}
        self.logs: dict = {}
        self.folder = f"{batch:012d}-{uuid.uuid4().hex}"
        self.written: dict[str, int] = {}

    def _write(self, table: str, df: DataFrame, suffix: str = "") -> tuple[str, int]:
        path = f"{self.store.root}/{table}/{self.folder}{suffix}"
        df.write.parquet(path)
        rows = self.store.spark.read.schema(df.schema).parquet(path).count()
        self.written[table] = self.written.get(table, 0) + rows
        return f"{self.folder}{suffix}", rows

    def read(self, table: str) -> DataFrame | None:
        return self.store.fold(table, self.state.get(table))

    def put(self, table: str, changed: DataFrame, gone: DataFrame | None = None) -> None:
        """Replace the rows of the keys in ``changed``, remove those in ``gone``."""
        delta = changed.withColumn("_gone", F.lit(False))
        if gone is not None:
            delta = delta.unionByName(gone.select(*KEYS[table]).withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        entry = self.state.get(table)
        if entry is None:
            rows = delta.where(~F.col("_gone"))
            self.state[table] = {"schema": rows.schema.json(), "base": self._write(table, rows), "deltas": []}
            return
        new = {"schema": entry["schema"], "base": entry["base"], "deltas": [*entry["deltas"], self._write(table, delta.select(*self._columns(entry)))]}
        if 2 * sum(n for _, n in new["deltas"]) > new["base"][1]:
            whole = self.store.fold(table, new).withColumn("_gone", F.lit(False))
            new = {"schema": entry["schema"], "base": self._write(table, whole.select(*self._columns(entry)), "-base"), "deltas": []}
        self.state[table] = new

    @staticmethod
    def _columns(entry: dict) -> list[str]:
        return [f["name"] for f in json.loads(entry["schema"])["fields"]]

    def log(self, table: str, df: DataFrame) -> None:
        self.logs[table] = [self._write(table, df)[0], df.schema.json()]

    def commit(self) -> None:
        store = self.store
        text = json.dumps({"batch": self.batch, "state": self.state, "logs": self.logs, "written": self.written})
        temporary = store._path(f"{store.root}/_manifest/.{self.folder}")
        stream = store._fs.create(temporary, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not store._fs.rename(temporary, store._path(store._manifest_file(self.batch))):
            raise RuntimeError(f"batch {self.batch} was committed by another attempt")
        self._remove_unnamed()

    def _remove_unnamed(self) -> None:
        """Folders of state tables that the last two manifests do not name, and of other attempts of this batch."""
        store = self.store
        kept: set[str] = set()
        for found in (store.manifest(self.batch), store.manifest(self.batch - 1)):
            for name, entry in (found or {"state": {}})["state"].items():
                kept |= {f"{name}/{folder}" for folder, _ in [entry["base"], *entry["deltas"]]}
        for name in KEYS:
            for folder in store.folders(name):
                if f"{name}/{folder}" not in kept and int(folder[:12]) <= self.batch:
                    store._fs.delete(store._path(f"{store.root}/{name}/{folder}"), True)
        for name, (own, _) in self.logs.items():
            for folder in store.folders(name):
                if folder.startswith(f"{self.batch:012d}-") and folder != own:
                    store._fs.delete(store._path(f"{store.root}/{name}/{folder}"), True)
