"""Text, JSON and archive sources through Spark's own readers, and small
files written by its tasks."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path, PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import page_of
from ..operators.orders import ranked


def stories(spark: SparkSession, path: str, glob: str = "*.icml") -> DataFrame:
    """(file_no, file_name, xml) of story files, numbered by page, name and
    path; the byte-order mark is dropped. Files of one name in several folders
    are files of their own."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    xml = F.regexp_replace(F.decode("content", "UTF-8"), r"\A\x{FEFF}", "")
    name = F.element_at(F.split("path", "/"), -1)
    # Numbers come from the paths alone.
    named = found.select("path", name.alias("file_name"), F.coalesce(page_of(name), F.lit(999_999)).alias("page"))
    order = ranked(named, ["page", "file_name", "path"], "file_no").select("path", "file_name", (F.col("file_no") - 1).cast("int").alias("file_no"))
    return found.select("path", xml.alias("xml")).join(order, "path").select("file_no", "file_name", "xml")


def hashed_files(spark: SparkSession, path: str, glob: str = "*", pattern: str | None = None, without: str | None = None) -> DataFrame:
    """(path, bytes, sha256) of files, filtered by patterns on the path."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    if pattern:
        found = found.where(F.col("path").rlike(pattern))
    if without:
        found = found.where(~F.col("path").rlike(without))
    return found.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("path")


def json_table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON documents of an explicit schema; what does not fit is an error."""
    return spark.read.schema(T._parse_datatype_string(ddl)).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def glossary_json(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Exploded glossary of a JSON object of objects, in file order."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"\A\x{FEFF}", "").alias("value"))
    entries = F.from_json("value", "map<string,map<string,string>>")
    each = whole.select(F.posexplode(F.map_entries(entries)).alias("ord", "e"))
    fields = each.select("ord", F.col("e.key").alias("source"), F.explode(F.map_entries("e.value")).alias("f"))
    return fields.select(F.lit(kind).alias("kind"), "source", F.col("f.key").alias("field"), F.coalesce("f.value", F.lit("")).alias("value"), F.col("ord").cast("long").alias("ord"))


def archive_members(spark: SparkSession, path: str, glob: str = "*.zip", most_bytes: int = 256 << 20) -> DataFrame:
    """(path, member, content, error) of the files in archives. Members that
    leave the archive, repeat, or make it larger than the bound are errors."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")

    def run(batches):
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(raw)) as z:
                        check_members(z, most_bytes)
                        for i in z.infolist():
                            if not i.is_dir():
                                yield pd.DataFrame({"path": [name], "member": [i.filename], "content": [z.read(i)], "error": [None]})
                except (ValueError, zipfile.BadZipFile) as e:
                    yield pd.DataFrame({"path": [name], "member": [None], "content": [None], "error": [str(e)]})

    return found.mapInPandas(run, "path string, member string, content binary, error string")


def check_members(archive: zipfile.ZipFile, most_bytes: int) -> None:
    seen: set[str] = set()
    for i in archive.infolist():
        parts = PurePosixPath(i.filename.replace("\\", "/"))
        if parts.is_absolute() or ".." in parts.parts or ":" in i.filename:
            raise ValueError(f"member leaves the archive: {i.filename}")
        if str(parts).lower() in seen:
            raise ValueError(f"member repeats: {i.filename}")
        seen.add(str(parts).lower())
    if sum(i.file_size for i in archive.infolist()) > most_bytes:
        raise ValueError("archive is over the size bound")


def expand_archive(source: str, target: str, most_bytes: int = 256 << 20) -> list[str]:
    """Extract on the driver, after all members have been checked."""
    with zipfile.ZipFile(source) as z:
        check_members(z, most_bytes)
        z.extractall(target)
        return sorted(n for n in z.namelist() if not n.endswith("/"))


def inside(candidate: str, parent: str) -> bool:
    """Strictly inside, links resolved."""
    a, b = Path(candidate).resolve(), Path(parent).resolve()
    return a != b and b in a.parents


# --- writing ----------------------------------------------------------------

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors see, below
    ``spark.checkpoint.dir``; it is deleted when the application ends. Where
    that is unset, a local master gets a folder of its own and any other
    master is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="textloom-files-")
            atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
        base = f"file://{_LOCAL[app]}"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(where)
    system.deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it again.
    Unlike a cached block, it survives the loss of an executor."""
    path = shared_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _put(url: str, data: bytes) -> None:
    """Write a whole file beside its place and move it there."""
    if "://" in url and not url.startswith("file:"):
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(url)
        staged = f"{path}.{uuid.uuid4().hex}.tmp"
        with store.open_output_stream(staged) as out:
            out.write(data)
        store.move(staged, path)
        return
    target = "/" + url.split(":", 1)[1].lstrip("/") if url.startswith("file:") else url
    os.makedirs(os.path.dirname(target), exist_ok=True)
    staged = f"{target}.{uuid.uuid4().hex}.tmp"
    with open(staged, "wb") as out:
        out.write(data)
    os.replace(staged, target)


def write_files(files: DataFrame, folder: str) -> int:
    """Write the rows (name, content) as files of ``folder``, each whole by one
    task; returns how many. A task that runs again writes the same bytes."""

    def run(batches):
        for pdf in batches:
            for name, content in zip(pdf["name"], pdf["content"]):
                _put(f"{folder}/{name}", bytes(content))
            yield pd.DataFrame({"n": [len(pdf)]})

    return files.select("name", "content").mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0
