"""CSV loads with records that can't be loaded, whole and incremental (SRC-02, SRC-04)."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import types as T

from aurum.sources.files import ingest_stream, read_ingested, read_source_csv

SCHEMA = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("name", T.StringType()),
                       T.StructField("born", T.DateType()), T.StructField("points", T.IntegerType())])
GOOD = ["id,name,born,points", "a,Per,1970-01-31,5", 'b,"Berg, Ole",NULL,', "b,N/A,1971-02-01,7", "b,N/A,1971-02-01,7"]
BAD = ["id,name,born,points", "c,Kari,1970-02-30,5", "NULL,Jon,1970-01-01,x", "d,Anna,1970-01-01", "e,Liv,1970-01-01,1,extra", "f,Bo,,2"]
REASONS = {("Kari", "born", "type", "1970-02-30"), ("Jon", "id", "missing", "NULL"), ("Jon", "points", "type", "x"),
           ("Anna", None, "columns", "d,Anna,1970-01-01"), ("Liv", None, "columns", "e,Liv,1970-01-01,1,extra")}


def _write(folder: Path, name: str, lines) -> str:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def _reasons(rejects):
    return {(r["name"], x["field"], x["reason"], x["value"]) for r in rejects.collect() for x in r["_rejects"]}


def test_whole_load(spark, tmp_path):
    path = _write(tmp_path / "in", "1.csv", GOOD)
    _write(tmp_path / "in", "2.csv", BAD)
    rows, rejects = read_source_csv(spark, path, SCHEMA)
    assert sorted((r["id"], r["name"]) for r in rows.collect()) == [("a", "Per"), ("b", "Berg, Ole"), ("b", "N/A"), ("b", "N/A"), ("f", "Bo")]
    assert dict(rows.dtypes)["born"] == "date" and dict(rows.dtypes)["points"] == "int"
    assert _reasons(rejects) == REASONS
    # what is rejected doesn't depend on the columns that a query reads
    assert rows.count() == 5 and rows.select("name").count() == 5 and rejects.count() == 4


def test_null_tokens_belong_to_a_source(spark, tmp_path):
    path = _write(tmp_path / "in", "1.csv", GOOD)
    rows, _ = read_source_csv(spark, path, SCHEMA, ("", "NULL", "null", "N/A"))
    assert [r["name"] for r in rows.where("born = '1971-02-01'").collect()] == [None, None]


def test_empty_folder_and_empty_file(spark, tmp_path):
    path = _write(tmp_path / "in", "1.csv", ["id,name,born,points"])
    rows, rejects = read_source_csv(spark, path, SCHEMA)
    assert rows.count() == 0 and rejects.count() == 0


@pytest.fixture
def dirs(tmp_path):
    return [str(tmp_path / x) for x in ("in", "table", "ckpt")]


def _ingest(spark, dirs, **kw):
    ingest_stream(spark, dirs[0], SCHEMA, dirs[1], dirs[2], **kw).awaitTermination()
    return read_ingested(spark, dirs[1])


def test_new_files_only(spark, tmp_path, dirs):
    _write(tmp_path / "in", "1.csv", GOOD)
    rows, rejects = _ingest(spark, dirs)
    assert (rows.count(), rejects.count()) == (4, 0)
    _write(tmp_path / "in", "2.csv", BAD)
    for _ in range(2):  # the second run finds nothing new
        rows, rejects = _ingest(spark, dirs)
        assert rows.count() == 5 and _reasons(rejects) == REASONS
    assert "_rejected" not in rows.columns and "_rejects" not in rows.columns


def test_rows_and_rejects_commit_together(spark, tmp_path, dirs):
    """A batch that dies after it wrote its files, before its commit: none of them is read, and its replay adds them once."""
    _write(tmp_path / "in", "1.csv", BAD)
    _ingest(spark, dirs)
    for log in (Path(dirs[1]) / "_spark_metadata" / "0", Path(dirs[1]) / "_spark_metadata" / ".0.crc",
                Path(dirs[2]) / "commits" / "0", Path(dirs[2]) / "commits" / ".0.crc"):
        log.unlink(missing_ok=True)
    left = [p for side in (0, 1) for p in Path(dirs[1], f"_rejected={side}").glob("*.parquet")]
    assert len(left) >= 2
    rows, rejects = _ingest(spark, dirs)
    assert rows.count() == 1 and _reasons(rejects) == REASONS
    # files that no log entry names stay invisible
    shutil.copy(left[0], left[0].with_name("part-stray.parquet"))
    rows, rejects = read_ingested(spark, dirs[1])
    assert rows.count() == 1 and rejects.count() == 4
