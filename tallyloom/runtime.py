"""Session helpers: shared scratch folder, written intermediate tables, size-checked broadcast."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_ROWS = 50_000

_written: ContextVar[list[DataFrame] | None] = ContextVar("written", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/tallyloom/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, survives lost executors and, unlike an RDD checkpoint, keeps column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    if (inside := _written.get()) is not None:
        inside.append(table)
    return table


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` itself if ``materialise`` has written it, otherwise its written table."""
    return df if getattr(df, "_stored_at", None) is not None else materialise(df, tag)


def tidy(job: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A job whose result is stored and whose other stored tables are deleted, also after an error.

    Tables stored by threads that the job starts are not seen.
    """

    @wraps(job)
    def run(*args, **options) -> DataFrame:
        own: list[DataFrame] = []
        token = _written.set(own)
        try:
            result = job(*args, **options)
            _written.reset(token)
            token = None
            return materialise(result, job.__name__.strip("_"))
        finally:
            if token is not None:
                _written.reset(token)
            discard(*own)

    return run


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` has written, once nothing reads them any more."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if path is not None:
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (as ``--py-files`` does)."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        home = Path(__file__).resolve().parent
        base = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")) / "tallyloom"
        spark.sparkContext.addPyFile(shutil.make_archive(str(base), "zip", home.parent, home.name))
        _shipped.add(app)


#: Spark's own bound on the bytes of an Arrow batch, and the one set in its place.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches of whole texts by bytes, unless the session has its own bound."""
    key, default, value = BATCH_BYTES
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, value)


def small_table(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows, otherwise return it without a hint."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema))


def join_rows(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join of two tables with a row per id, through a shuffle.

    Both grow with the input. How few bytes one takes as a stored, packed table, of which a column or two are read, would
    make Spark take it for a small one and send all of its rows through the driver.
    """
    return left.join(right.hint("merge"), on, how)


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Broadcast table of driver-side rows whose number the caller has bounded."""
    empty = spark.createDataFrame([], schema)
    names = empty.columns
    data = [tuple(r[c] for c in names) for r in rows]
    if not data:
        return F.broadcast(empty)
    table = pa.table({c: [r[i] for r in data] for i, c in enumerate(names)})
    if any(pa.types.is_null(t) for t in table.schema.types):
        return F.broadcast(spark.createDataFrame(data, schema))
    return F.broadcast(spark.createDataFrame(table, schema=empty.schema))
