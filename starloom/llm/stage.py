"""Small Spark helpers of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterable
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_shipped: set[str] = set()
_left: dict[str, object] = {}  # in a worker, by operator


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROWS = {"default": "10000", "texts": "1000"}


def ship(spark: SparkSession) -> None:
    """Send the library to the executors' Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='llm-')}/starloom", "zip", root, "starloom"
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def short_batches(spark: SparkSession) -> None:
    """Batches of Spark's default of 10,000 rows are made for numbers; with whole texts they take
    a worker and its executor some hundred megabytes, so a session with that default gets 1,000."""
    if spark.conf.get(_BATCH, _ROWS["default"]) == _ROWS["default"]:
        spark.conf.set(_BATCH, _ROWS["texts"])


def left(operator: str, fits: Callable[[object], bool], make: Callable[[], object]):
    """What tasks of an operator left in this worker for later ones, or else a new one. It stays
    until a task of another operator runs here (``release``)."""
    if operator not in _left or not fits(_left[operator]):
        _left[operator] = make()
    return _left[operator]


def release(operator: str = "") -> None:
    """Give memory that a task of a Python worker has freed back to the system. The C library keeps
    some hundred megabytes of it else, in each of the workers that wait for other stages. What
    tasks of any other operator left goes, too: workers take turns, so all of them would hold it."""
    for other in [name for name in _left if name != operator]:
        del _left[other]
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other systems have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a temporary folder only where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="llm-"))
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid4().hex}"


class Tables:
    """Written intermediate tables; ``drop`` deletes those that are not needed any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self.spark, name)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        back._llm_path = path  # keeps the id from being used again while the table is known
        return back

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 2 modulo 4; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2


def below_hash(hashed: Column, wanted: int, rows: int) -> Column:
    """Whether a 64-bit hash is among the lowest, so many that ``wanted`` of ``rows`` rows and some
    more are expected there: what is sorted to draw them does not grow with the input."""
    share = 1.25 * (wanted + 1000) / max(rows, 1)
    return F.lit(True) if share >= 1 else hashed < -(1 << 63) + int(share * (1 << 64))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
