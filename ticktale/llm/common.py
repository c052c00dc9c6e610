"""Shared pieces: the word pattern, the documents reader, tables written to the
cluster's shared folder, and the hash functions used inside tasks."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticktale.session import ensure_checkpoint_dir
from ticktale.sources.tables import table

#: A word is a run of anything but the six ASCII white-space characters; on
#: UTF-8 bytes this is exactly ``bytes.split()``.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents", *columns)


def text_of(column: str = "text") -> Column:
    """The text, null counted as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: a lambda variable
    is bound once, while a repeated expression may be computed again for
    every reference inside a higher-order function."""
    return F.transform(F.array(value), body).getItem(0)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read
    it back: lineage is cut and the rows survive lost executors. (A
    checkpoint() would run the last stage twice.)"""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_cache(key: str, make):
    """An object that lives as long as the Python worker, made at first use.
    This package travels inside each task by value, so its module globals die
    with the task; the cache is a module of its own. ``key`` names all that the
    object depends on; callers bound its size."""
    home = sys.modules.get("_ticktale_worker_cache")
    if home is None:
        home = sys.modules["_ticktale_worker_cache"] = types.ModuleType("_ticktale_worker_cache")
    entries = vars(home).setdefault("entries", {})
    if key not in entries:
        entries[key] = make()
    return entries[key]


MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every input bit."""
    z = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * MIX_A
    z = (z ^ (z >> np.uint64(27))) * MIX_B
    return z ^ (z >> np.uint64(31))
