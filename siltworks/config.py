"""Run parameters, fixed values and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# They are part of stored results, so they never change.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"
MASTER_ID_PREFIX = "DTU_PERSON_"
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


@dataclass(frozen=True)
class RunConfig:
    """Values a run is given once; operators never read the clock."""

    run_time: dt.datetime = dt.datetime(2024, 2, 1, 6, 0, 0)
    as_of: dt.date = dt.date(2024, 2, 1)
    institution_code: str = "UNKNOWN"
    time_zone: str = "UTC"


def shared_dir(spark: SparkSession) -> str:
    """A new folder for tables of this run, in the folder the cluster shares.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a temporary folder, since there driver and executors are one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_dir()
    folder = f"{base.rstrip('/')}/siltworks/{uuid.uuid4().hex}"
    for made in _watching:
        made.append(folder)
    return folder


_watching: list[list[str]] = []


@contextmanager
def folders_made():
    """The list of folders that ``shared_dir`` names inside the block."""
    made: list[str] = []
    _watching.append(made)
    try:
        yield made
    finally:
        _watching[:] = [m for m in _watching if m is not made]


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more, through the file system that holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="siltworks-")


def keep(df: DataFrame, folder: str) -> DataFrame:
    """The table written to ``folder`` and read back, so later steps neither recompute it nor
    depend on the executors that made it."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def own_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session beside the caller's, with its settings but for those given; the caller's stays as it is."""
    own = spark.newSession()
    for name, value in {**spark.conf.getAll, **settings}.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own
