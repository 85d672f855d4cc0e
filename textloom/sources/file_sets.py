"""File sets whose contents are written by tasks.

``df.write.format("textloom_file_set").save(folder)`` adds a version to the
``plans.commit.FileSet`` in a folder. Tasks stream each file into the set,
whether plain or an archive with its directory, and put names and hashes into
sorted runs; one step of the driver merges the runs, entry by entry, and
publishes them all. A task that fails or
runs again leaves contents that no version names, and a job that fails
publishes nothing.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, groupby, islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..plans.commit import CommitError, FileSet, LocalStore, part_entries
from .sheet_source import _opened, _store

FORMAT = "textloom_file_set"
SCHEMA = "name string, member string, seq long, content binary"
#: A fixed date, so that equal members give equal bytes.
DATE = (1980, 1, 1, 0, 0, 0)
BLOCK = 1 << 20
#: Files that a task names in its message; more go into runs of at most RUN,
#: of which READ bytes are held at a time.
TOLD, RUN, READ = 256, 1 << 16, 1 << 16


class ArrowStore:
    """The objects of a ``FileSet`` on a store that pyarrow knows; ``create``
    needs one whose move fails on an existing target."""

    def __init__(self, fs, root: str):
        self.fs, self.root = fs, root.rstrip("/")

    def _exists(self, name: str) -> bool:
        from pyarrow.fs import FileType

        return self.fs.get_file_info(f"{self.root}/{name}").type != FileType.NotFound

    def read(self, name: str) -> bytes | None:
        if not self._exists(name):
            return None
        with self.fs.open_input_stream(f"{self.root}/{name}") as stream:
            return stream.read()

    def create(self, name: str, data: bytes) -> bool:
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.root}/staged")
        self.fs.create_dir(f"{self.root}/{name}".rsplit("/", 1)[0])
        with self.fs.open_output_stream(staged) as out:
            out.write(data)
        try:
            if not self._exists(name):
                self.fs.move(staged, f"{self.root}/{name}")
                return True
        except OSError:
            if not self._exists(name):
                raise
        self.fs.delete_file(staged)
        return False

    def names(self, folder: str) -> list[str]:
        from pyarrow.fs import FileSelector

        found = self.fs.get_file_info(FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return sorted(i.base_name for i in found if not i.base_name.startswith("."))

    def delete(self, name: str) -> None:
        if self._exists(name):
            self.fs.delete_file(f"{self.root}/{name}")


def opened_set(folder: str) -> FileSet:
    """The file set in a folder, given as a path or url."""
    store, path = _store(folder)
    return FileSet(LocalStore(path) if store is None else ArrowStore(store, path))


class _Content:
    """A content on its way into a set: staged until it is whole, then named
    by its hash. It cannot seek, so what is hashed is what is kept."""

    def __init__(self, folder: str):
        self.store, self.root = _store(folder.rstrip("/"))
        self.staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        self.sha, self.size = hashlib.sha256(), 0
        for place in ("staged", "data"):
            if self.store is None:
                os.makedirs(f"{self.root}/{place}", exist_ok=True)
            else:
                self.store.create_dir(f"{self.root}/{place}")
        self.raw = open(self.staged, "wb") if self.store is None else self.store.open_output_stream(self.staged)

    def write(self, data) -> int:
        self.raw.write(data)
        self.sha.update(data)
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        """Nothing: the content counts once it is whole."""

    def keep(self) -> str:
        name = self.sha.hexdigest()
        final = f"{self.root}/data/{name}"
        if self.store is None:
            self.raw.flush()
            os.fsync(self.raw.fileno())
            self.raw.close()
            os.replace(self.staged, final)  # same name, same bytes
            return name
        self.raw.close()
        held = ArrowStore(self.store, self.root)
        if held._exists(f"data/{name}"):
            self.store.delete_file(self.staged)
        else:
            try:
                self.store.move(self.staged, final)
            except OSError:  # another attempt was first
                if not held._exists(f"data/{name}"):
                    raise
        return name

    def drop(self) -> None:
        self.raw.close()
        if self.store is None:
            os.unlink(self.staged)
        else:
            self.store.delete_file(self.staged)


def _inside(name: str) -> str:
    if not name or name.startswith("/") or "\\" in name or ".." in name.split("/"):
        raise CommitError(f"no name inside the set: {name!r}")
    return name


def _put_members(out: _Content, parts: Iterable[tuple]) -> None:
    """An archive of members given in chunks, none of them held whole."""
    seen = set()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for member, rows in groupby(parts, key=lambda r: r[1]):
            if member is None:
                raise CommitError("a file has members and chunks of its own")
            if member.lower() in seen:
                raise CommitError(f"member repeats: {member}")
            seen.add(member.lower())
            info = zipfile.ZipInfo(_inside(member), DATE)
            info.compress_type = zipfile.ZIP_DEFLATED
            chunks = (r[3] for r in rows)
            first, second = next(chunks), next(chunks, None)
            if second is None:
                archive.writestr(info, first)
                continue
            with archive.open(info, "w", force_zip64=True) as held:  # of unknown length
                for c in chain((first, second), chunks):
                    held.write(c)


def _checked(parts: Iterable[tuple]) -> Iterator[tuple]:
    """Chunks in order, null ones empty; two of one number are an error."""
    last = None
    for name, member, seq, content in parts:
        key = (member, seq)
        if seq is None or key == last:
            raise CommitError(f"chunks of {name} without numbers of their own")
        last = key
        yield name, member, seq, bytes(content or b"")


def stored(rows: Iterable[tuple], folder: str) -> Iterator[tuple[str, str, int]]:
    """Put files, given as (name, member, seq, content) in this order, into
    the set's contents; (name, hash, bytes) of each."""
    for name, parts in groupby(rows, key=lambda r: r[0]):
        _inside(name or "")
        out = _Content(folder)
        try:
            parts = _checked(parts)
            first = next(parts)
            if first[1] is None:
                for r in chain((first,), parts):
                    if r[1] is not None:
                        raise CommitError("a file has members and chunks of its own")
                    out.write(r[3])
            else:
                _put_members(out, chain((first,), parts))
            yield name, out.keep(), out.size
        except BaseException:
            if not out.raw.closed:
                out.drop()
            raise


def _put_run(rows: list[tuple[str, str, int]], folder: str) -> str:
    """Write a sorted run of (name, hash, bytes); its name in the set."""
    store, root = _store(folder.rstrip("/"))
    name, body = f"staged/{uuid.uuid4().hex}.run", "".join(json.dumps(r) + "\n" for r in sorted(rows)).encode()
    with open(f"{root}/{name}", "wb") if store is None else store.open_output_stream(f"{root}/{name}") as out:
        out.write(body)
    return name


def _run_rows(folder: str, name: str) -> Iterator[tuple[str, str, int]]:
    """Rows of a run, read by blocks; the file is open only while one is read."""
    at, rest = 0, b""
    while True:
        with _opened(f"{folder.rstrip('/')}/{name}") as raw:
            raw.seek(at)
            block = raw.read(READ)
        if not block:
            return
        at += len(block)
        *lines, rest = (rest + block).split(b"\n")
        for line in lines:
            yield tuple(json.loads(line))


@dataclass
class _Stored(WriterCommitMessage):
    files: list = field(default_factory=list)
    runs: list = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool, record: str | None, facts: str | None):
        self.folder, self.overwrite, self.record, self.facts = folder, overwrite, record, facts
        self.began = opened_set(folder).newest()

    def write(self, iterator):
        def rows():
            for batch in iterator:
                columns = [batch.column(n) for n in ("name", "member", "seq", "content")]
                for i in range(batch.num_rows):
                    yield tuple(c[i].as_py() for c in columns)

        files = stored(rows(), self.folder)
        told = list(islice(files, TOLD + 1))
        if len(told) <= TOLD:
            return _Stored(told)
        files, runs = chain(told, files), []
        while held := list(islice(files, RUN)):
            runs.append(_put_run(held, self.folder))
        return _Stored([], runs)

    def _fresh(self, messages) -> Iterator[tuple[str, str, int]]:
        """Files of all tasks by name; only a block of each run is held."""
        told = sorted(f for m in messages for f in m.files)
        last = None
        for f in heapq.merge(told, *(_run_rows(self.folder, r) for m in messages for r in m.runs)):
            if f[0] == last:
                raise CommitError("a file came from two tasks, or not in order")
            last = f[0]
            yield f

    def _put_record(self, messages) -> str:
        facts = {k: v for k, v in json.loads(self.facts or "{}").items() if k != "files"}
        out = _Content(self.folder)
        try:
            out.write((json.dumps(facts, ensure_ascii=False)[:-1] + ", " * bool(facts) + '"files": {').encode())
            between = ""
            for name, sha, size in self._fresh(messages):
                out.write(f"{between}{json.dumps(name, ensure_ascii=False)}: {json.dumps({'bytes': size, 'sha256': sha})}".encode())
                between = ", "
            out.write(b"}}")
            return out.keep()
        except BaseException:
            if not out.raw.closed:
                out.drop()
            raise

    def commit(self, messages):
        messages = [m for m in messages if m is not None]
        held = opened_set(self.folder)
        record = [(self.record, self._put_record(messages))] if self.record else []

        def fresh():
            files = ((name, sha) for name, sha, _ in self._fresh(messages) if name != self.record)
            return heapq.merge(record, files)

        held.publish_sorted(fresh, self.began, self.overwrite)
        for m in messages:
            for run in m.runs:
                held.store.delete(run)

    def abort(self, messages):
        """Nothing to undo: no version names what was stored."""


class FileSetSink(DataSource):
    """Options: path (the set's folder), record (name of a file that lists
    the files of this write with bytes and hashes) and facts (JSON object put
    into the record). Mode append puts files in, overwrite replaces all."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite, self.options.get("record"), self.options.get("facts"))


def write_set(files: DataFrame, folder: str, overwrite: bool = False, record: str | None = None, facts: dict | None = None) -> int:
    """Publish files (name, member, seq, content) as one new version of the
    set in ``folder``; returns its number.

    A row is a chunk, at the place ``seq``, of the plain file ``name`` (member
    null) or of a member of the archive ``name``. Null contents are empty. A
    file is written by one task in bounded memory, so what may grow goes into
    several files. Another version published meanwhile is an error if it
    touches the same files. The driver merges names and hashes as a stream.
    """
    spark = files.sparkSession
    spark.dataSource.register(FileSetSink)
    rows = files.select("name", "member", F.col("seq").cast("long").alias("seq"), F.col("content").cast("binary").alias("content"))
    # A stated number, so that small files are not all left to one task.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = rows.repartition(n, "name").sortWithinPartitions("name", "member", "seq").write.format(FORMAT)
    if record:
        out = out.option("record", record).option("facts", json.dumps(facts or {}))
    out.mode("overwrite" if overwrite else "append").save(folder)
    return opened_set(folder).newest()


def _hash_of(url: str) -> str:
    sha = hashlib.sha256()
    with _opened(url) as raw:
        while block := raw.read(BLOCK):
            sha.update(block)
    return sha.hexdigest()


def set_entries(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """(name, sha) of a version's files; parts of a long list are read by
    tasks."""
    root = folder.rstrip("/")
    files, parts = opened_set(folder).listing(version)
    if not parts:
        return spark.createDataFrame(list(files.items()), "name string, sha string")

    def run(batches):
        for pdf in batches:
            for part in pdf["part"]:
                with _opened(f"{root}/data/{part}") as raw:
                    yield pd.DataFrame(part_entries(raw.read(), part), columns=["name", "sha"])

    listed = spark.createDataFrame([(p,) for p in parts], "part string")
    return listed.repartition(len(parts), "part").mapInPandas(run, "name string, sha string")


def set_files(spark: SparkSession, folder: str, version: int | None = None, archives: str = r"\.(zip|xlsx)$", only: str = "true") -> DataFrame:
    """(name, member, content, error) of a version's files whose name meets
    the condition ``only``, read by tasks and checked against their hashes; names that match ``archives`` give a row a
    member. A missing or damaged content is a row with its error."""
    root = folder.rstrip("/")
    entries = set_entries(spark, folder, version).where(only)
    rows = entries.select("name", F.concat(F.lit(f"{root}/data/"), "sha").alias("url"), "sha")

    def one(name, url, sha):
        try:
            if _hash_of(url) != sha:
                raise ValueError("content is not what was published")
            with _opened(url) as raw:
                if not re.search(archives, name):
                    yield name, None, raw.read(), None
                    return
                with zipfile.ZipFile(raw) as archive:
                    for i in archive.infolist():
                        yield name, i.filename, archive.read(i), None
        except (OSError, ValueError, zipfile.BadZipFile) as e:
            yield name, None, None, str(e)

    def run(batches):
        held, size = [], 0
        frame = lambda: pd.DataFrame(held, columns=["name", "member", "content", "error"])
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                for r in one(*row):
                    held.append(r)
                    size += len(r[2] or b"")
                    if size >= BLOCK or len(held) >= 1024:
                        yield frame()
                        held, size = [], 0
        if held:
            yield frame()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "name").mapInPandas(run, "name string, member string, content binary, error string")
