"""The folder that driver and executors share, and the intermediate tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Where it is unset, a local session gets a temporary folder; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; sweep deletes it."""
    path = f"{shared_dir(spark)}/quern-{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settled(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: cuts lineage, survives lost executors, and may be read more than once."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark(spark: SparkSession) -> int:
    """How many paths there are now, for sweep."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def sweep(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete what this application has settled since mark (all of it by default), but for the files of the table `keep`.

    For the end of a job, when no result is in use: results of the library may still read settled tables.
    """
    made = _made.get(spark.sparkContext.applicationId, [])
    files = keep.inputFiles() if keep is not None else []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in made[since:]:
        if not any(path.rsplit("/", 1)[1] in f for f in files):
            target = hadoop.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
            made.remove(path)
