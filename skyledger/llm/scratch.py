"""Intermediate tables in the folder that all executors share, free column names, and broadcasts that need no repository."""

from __future__ import annotations

import ctypes
import pickle
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Spark then deletes a query's shuffle files when the query ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder of the warehouse, which executors share too."""
    where = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    return where.rstrip("/")


def fresh(name: str, *taken: DataFrame | list[str]) -> str:
    """``name``, or with as many underscores in front as it takes to be no column of ``taken``; case doesn't tell columns apart."""
    used = {c.lower() for t in taken for c in (t.columns if isinstance(t, DataFrame) else t)}
    while name.lower() in used:
        name = f"_{name}"
    return name


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A broadcast value for use on executors. Its classes travel with it, as a plain broadcast pickles them by reference."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


MADE: list[Scratch] = []


@contextmanager
def released() -> Iterator[None]:
    """Deletes all intermediate tables made inside when it ends. Results that read them must be written by then."""
    before = len(MADE)
    try:
        yield
    finally:
        for scratch in MADE[before:]:
            scratch.keep()
        del MADE[before:]


class Scratch:
    """Tables written once and reread, which cuts lineage and survives lost executors.

    ``drop`` and ``keep`` delete what no later plan reads; the rest goes when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.tables = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}", {}
        path, system = self._path(self.root)
        system.deleteOnExit(path)
        MADE.append(self)

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def save(self, df: DataFrame, rows_per_file: int = 0) -> DataFrame:
        """``rows_per_file`` bounds what a task holds of a table of large rows; 0: no bound."""
        path = f"{self.root}/{len(self.tables)}"
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
        finally:
            self.spark.conf.unset(CLEANUP) if before is None else self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        self.tables[path] = True
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        for table in tables:
            if self.tables.get(table.scratch_path):
                path, system = self._path(table.scratch_path)
                system.delete(path, True)
                self.tables[table.scratch_path] = False

    def keep(self, *tables: DataFrame) -> None:
        """Delete all tables but these."""
        kept = {t.scratch_path for t in tables}
        for name, there in list(self.tables.items()):
            if there and name not in kept:
                path, system = self._path(name)
                system.delete(path, True)
                self.tables[name] = False


def give_back() -> None:
    """Returns freed memory to the system: workers stay for later tasks, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def add_columns(docs: DataFrame, inputs: list[Column], keep: list[str], added: dict[str, DataType], start: Callable[[], Callable[..., list[pa.Array]]], step: int = 256) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``added`` ones, which ``start()(*arrays of the inputs)`` gives for ``step`` rows at a time on executors.

    Columns travel under numbers, so any name may be kept. An added name that is kept too gets underscores in front.
    """
    kinds = [docs.schema[c].dataType for c in keep] + list(added.values())
    schema = StructType([StructField(f"c{i}", kind) for i, kind in enumerate(kinds)])
    n = len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                part = batch.slice(low, step)
                yield pa.RecordBatch.from_arrays([*part.columns[n:], *work(*part.columns[:n])], names=schema.names)
        del work
        give_back()

    chosen = [c.alias(f"i{i}") for i, c in enumerate(inputs)] + [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    return docs.select(*chosen).mapInArrow(run, schema).toDF(*keep, *(fresh(c, keep) for c in added))
