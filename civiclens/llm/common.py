"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclens.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share
    (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def tidy(run):
    """A function for ``mapInArrow`` whose Python worker gives its free memory
    back when a task ends: workers idle on beside those of later stages."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # another C library
                pass
    return tidied


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Jobs in this block hand Python batches of at most ``size`` bytes or one
    row, so a worker's memory follows neither its partition nor long texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that are :func:`written` in this block are deleted at its end, but
    for those written to be kept: their last reader has run by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            _delete(spark, path)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed
    once for several consumers, lineage cut, and safe when executors go."""
    path = shared_path(df.sparkSession, name)
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a ``written`` frame that nothing reads any more."""
    spark = df.sparkSession
    paths = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for p in paths:
        _delete(spark, p)


def boxed(df: DataFrame) -> DataFrame:
    """``df`` as the one column ``row``, a struct: no name of its columns can
    clash with another column."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unboxed(columns: list[str], **changed: Column) -> list[Column]:
    """The columns of a :func:`boxed` frame, some of them changed."""
    row = F.col("row")
    return [changed.get(c, row.getField(c)).alias(c) for c in columns]


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with as many ``_`` behind it as no column needs."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.  ``lower`` does just that on texts
    without other capitals and is much faster than ``translate``."""
    other = text.rlike(r"[\p{javaUpperCase}\p{javaTitleCase}&&[^A-Z]]")
    return F.when(other, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, _h``: rows with equal (doc_id, _h) are repeated rows."""
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"))


def same_key(a: DataFrame, b: DataFrame, *cols: str) -> Column:
    """Null-safe equality of the named columns of two frames."""
    cond = F.lit(True)
    for i, c in enumerate(cols):
        eq = a[c].eqNullSafe(b[c])
        cond = eq if i == 0 else cond & eq
    return cond


def join_on(a: DataFrame, b: DataFrame, cols: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps one copy of the key columns."""
    b = b.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in b.columns])
    cond = None
    for c in cols:
        eq = a[c].eqNullSafe(b[f"_r_{c}"])
        cond = eq if cond is None else cond & eq
    out = a.join(b, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{c}" for c in cols])
