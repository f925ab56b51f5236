"""What the operators of this package share: inputs, stage tables, row-wise Python."""

from __future__ import annotations

import contextlib
import sys
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows that leave Python at a time, and bytes of text that enter a chunk of work.
CHUNK_BYTES = 2 << 20


def row_type(**fields: str | T.DataType) -> T.StructType:
    """A schema from names and types; simple types by their names."""
    schema = T.StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind)
    return schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach.

    Only a local master, which is a single machine, may go without the setting.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="llm-")


class _Within(threading.local):
    """The scratch folders that a thread works in, the inner one last."""

    def __init__(self) -> None:
        self.folders: list[str] = []


_WITHIN = _Within()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Stage tables made inside lie in a folder of their own, deleted at the end.

    What reads them must have been written elsewhere by then.
    """
    folder = stage_path(spark, "scratch")
    _WITHIN.folders.append(folder)
    try:
        yield folder
    finally:
        _WITHIN.folders.remove(folder)
        drop_stage(spark, folder)


def stage_path(spark: SparkSession, label: str) -> str:
    root = _WITHIN.folders[-1] if _WITHIN.folders else shared_folder(spark)
    return f"{root}/llm-{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    This cuts the lineage: what is written survives lost executors.
    """
    path = stage_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The session with some settings, as they were afterwards."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a stage table that nothing reads any more."""
    if "/llm-" not in path:
        raise ValueError(f"not a stage table: {path}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def once_per_worker(key: object, make: Callable[[], object]) -> object:
    """An object that the tasks of a Python worker share.

    Tasks carry this package's code by value, so what a module holds is new in each.
    """
    held = sys.__dict__.setdefault("_warcloom_once", {})
    if key not in held:
        held[key] = make()
    return held[key]


def ascii_lower(text: str | Column) -> Column:
    """A to Z in lower case, all other characters as they are."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame less columns that results replace; names compare as Spark's do."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The same work, with the memory of a task given back when it ends.

    Python workers are kept for later tasks and stages, of other operators too. What a
    task's tables of words and its batches took would stay with them.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return tidy


def chunks(batches: Iterator[pa.RecordBatch], *columns: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds some MB in some columns, or a single longer row."""
    for batch in batches:
        places = [batch.schema.get_field_index(c) for c in columns]
        start, n = 0, batch.num_rows
        size = max(1, sum(batch.column(p).nbytes for p in places) // max(1, n))
        step = max(1, limit // size)
        while start < n:
            yield batch.slice(start, min(step, n - start))
            start += step


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t if t is not None else "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def add_columns(
    df: DataFrame,
    column: str,
    results: T.StructType,
    make: Callable[[], Callable[[list[str]], list[list]]],
    drop: Iterable[str] = (),
) -> DataFrame:
    """Add columns computed in Python from a text column, chunk by chunk.

    ``make()`` runs once per task and returns a function from a list of texts to one
    list per result column. Columns in ``drop`` are not carried on.
    """
    kept = without(df, [f.name for f in results])
    gone = {d.lower() for d in drop}
    carried = [f for f in kept.schema.fields if f.name.lower() not in gone]
    schema = T.StructType([*carried, *results.fields])
    names = [f.name for f in carried]
    # A text column that a result replaces is still the input of the work.
    source = "__text"
    frame = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{column}`").cast("string").alias(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(results)
        work = make()
        for batch in chunks(batches, source):
            made = work(texts_of(batch, source))
            arrays = [batch.column(i) for i in range(len(names))]
            arrays += [pa.array(v, type=f.type) for v, f in zip(made, arrow)]
            fields = [*[batch.schema.field(i) for i in range(len(names))], *arrow]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    return frame.mapInArrow(tidied(run), schema)
