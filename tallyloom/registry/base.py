"""Query table and the tables that several queries start from."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.split import stratified_split
from tallyloom.runtime import materialise, ship_package
from tallyloom.sources import adapters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_stored: dict[tuple[str, str, str], DataFrame] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _once(spark: SparkSession, sf_dir: str, tag: str, build) -> DataFrame:
    """Written once per application: the tables that jobs hand to each other."""
    key = (spark.sparkContext.applicationId, sf_dir, tag)
    if key not in _stored:
        _stored[key] = materialise(build(), tag)
    return _stored[key]


def noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "noise", lambda: adapters.noise_scores(spark, sf_dir))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with their ``split``."""
    return _once(spark, sf_dir, "prepared", lambda: stratified_split(adapters.labelled(spark, sf_dir)))


def train_valid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = prepared(spark, sf_dir)
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'valid'").drop("split")


def r6(*columns: str) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in columns]
