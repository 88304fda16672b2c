"""What the operators of this subpackage need of a session and of its workers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyloom.runtime import ship_package

#: Settings that ``prepare`` changes from their defaults, unless the session has its own.
SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m"),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": ("false", "true"),
}

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def prepare(spark: SparkSession) -> None:
    """Ship the package, bound Arrow batches of whole texts by 8 MB, and let Spark delete the shuffle files of
    finished steps, whose results are stored."""
    ship_package(spark)
    for key, (default, value) in SETTINGS.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores more as no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_kept: dict[str, tuple[object, object]] = {}


def kept(name: str, key: object, make: Callable[[], object]) -> object:
    """What ``make`` gives for ``key``, kept by this worker for its next tasks that ``lean`` lets keep ``name``."""
    if name not in _kept or _kept[name][0] != key:
        _kept.pop(name, None)
        _kept[name] = key, make()
    return _kept[name][1]


def drop_kept(but: str) -> None:
    """Free what is kept under other names, with the cycles in it."""
    names = [n for n in _kept if n != but]
    for name in names:
        del _kept[name]
    if names:
        gc.collect()


def lean(batches: Batches, keeps: str = "") -> Batches:
    """The same function; a worker gives memory it has freed back at the end of a task, since Spark keeps it for later ones.
    What it has ``kept`` for the tasks of another function goes at the start."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(keeps)
        try:
            yield from batches(source)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
