"""Tables put in place together, after their checks.

A publication has two steps. First every table is written beside its place, into a
folder of its own, and checked there; a failed check leaves what is published as it
was. Then the tables are moved, by renames of the file system: what stood there goes
aside, the new folder takes its place. A journal names the moves before the first one, so
a publication that was interrupted between two moves is finished by ``recover``. Renames
are atomic on HDFS and local file systems; on object stores they are copies.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from starloom.sources.sink import table_path, write_table
from starloom.specs import SinkSpec

JOURNAL = "_publication.json"


class Files:
    """A few operations of the Hadoop file system that a path belongs to."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        """Atomically: a reader sees all of it or nothing."""
        beside = f"{path}.{uuid4().hex}"
        stream = self._fs.create(self._path(beside), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(beside, path)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def stage(df: DataFrame, sink: SinkSpec, publication: str) -> str:
    """Write a table beside its place and return where."""
    return write_table(df, SinkSpec(f"{sink.path.rstrip('/')}/_staged-{publication}", sink.name, sink.partition_by))


def publish(
    tables: Mapping[str, DataFrame],
    sinks: Mapping[str, SinkSpec],
    check: Callable[[dict[str, DataFrame]], None] = lambda staged: None,
) -> dict[str, DataFrame]:
    """Write all tables at the same time, check them and move them; returns them as published.

    ``check`` gets the staged tables, read back from their files, and raises if they must not be
    published. Tables of several folders have a journal in each.
    """
    spark = next(iter(tables.values())).sparkSession
    publication = uuid4().hex
    folders = list(dict.fromkeys(sinks[name].path.rstrip("/") for name in tables))
    for folder in folders:
        recover(spark, folder)
    try:
        with ThreadPoolExecutor(len(tables)) as pool:
            put = inheritable_thread_target(spark)(stage)
            paths = pool.map(lambda name: put(tables[name], sinks[name], publication), tables)
            staged = dict(zip(tables, paths, strict=True))
        check({name: _read(spark, tables[name], path) for name, path in staged.items()})
    except BaseException:
        for folder in folders:
            Files(spark, folder).delete(f"{folder}/_staged-{publication}")
        raise
    for folder in folders:
        moves = [
            [staged[name], table_path(sinks[name]), f"{folder}/_before-{publication}/{sinks[name].name}"]
            for name in tables
            if sinks[name].path.rstrip("/") == folder
        ]
        journal = json.dumps({"publication": publication, "moves": moves})
        Files(spark, folder).write(f"{folder}/{JOURNAL}", journal)
    for folder in folders:
        recover(spark, folder)
    return {name: _read(spark, df, table_path(sinks[name])) for name, df in tables.items()}


def _read(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    columns = [f"`{c}`" for c in df.columns]
    return spark.read.schema(df.schema).parquet(path).select(*columns)


def recover(spark: SparkSession, folder: str) -> bool:
    """Finish the moves of a journal in ``folder``, if there is one; whether there was.

    Each move is found in one of three states and carried on from there, so this can be
    interrupted and run again.
    """
    folder = folder.rstrip("/")
    files = Files(spark, folder)
    if not files.exists(f"{folder}/{JOURNAL}"):
        return False
    journal = json.loads(files.read(f"{folder}/{JOURNAL}"))
    for _ in _moved(files, journal["moves"]):
        pass
    for kind in ("staged", "before"):
        files.delete(f"{folder}/_{kind}-{journal['publication']}")
    files.delete(f"{folder}/{JOURNAL}")
    return True


def _moved(files: Files, moves: list[list[str]]) -> Iterator[str]:
    for staged, place, before in moves:
        if not files.exists(staged):
            continue  # in its place already
        if files.exists(place):
            if files.exists(before):  # cannot be: what stood there went aside once
                raise OSError(f"{place} was written to during a publication")
            files.move(place, before)
        files.move(staged, place)
        yield place
