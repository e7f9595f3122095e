"""Scans and sinks: JSON lines, text, discovery, partitioned and staged writes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CONVERSATION = "ordinal long, conversations array<struct<from: string, value: string>>"
EXAMPLE = "ordinal long, messages array<struct<role: string, content: string>>"


def rows_source(spark: SparkSession, rows: Iterable[dict], schema: str | StructType) -> DataFrame:
    """Injected rows, as tests and adapters use them."""
    return spark.createDataFrame(list(rows), schema)


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out anew only if its scan has fewer partitions than there are cores; a large input stays where it is.

    A small table may be one file of one row group, which one task would otherwise work on alone.
    """
    plan = getattr(df, "_jdf", None)
    if plan is None:  # a remote session plans on the server
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if plan.queryExecution().toRdd().getNumPartitions() < cores else df


def read_jsonl(spark: SparkSession, path: str, schema: str | StructType, own: bool = False) -> DataFrame:
    """JSON lines under an explicit schema. Foreign files keep bad lines in _corrupt_record; our own files fail on one."""
    s = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if own:
        return spark.read.schema(s).option("mode", "FAILFAST").json(path)
    return spark.read.schema(StructType([*s.fields]).add("_corrupt_record", "string")).option("mode", "PERMISSIVE").json(path)


def write_jsonl(df: DataFrame, path: str, least: int | None = None, one_file: bool = False) -> int:
    """Write JSON lines, published only when complete: the rows go to a folder beside path, are counted, then moved into place.

    With `least`, fewer rows raise and nothing is published. Null fields are kept.
    """
    spark, staged = df.sparkSession, path.rstrip("/") + ".staged"
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("ignoreNullFields", "false").json(staged)
    n = spark.read.text(staged).count()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    src, dst = hadoop.Path(staged), hadoop.Path(path)
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if least is not None and n < least:
        fs.delete(src, True)
        raise RuntimeError(f"only wrote {n} of {least}")
    fs.delete(dst, True)
    fs.rename(src, dst)
    return n


def discover(spark: SparkSession, root: str, name: str, depth: int = 2) -> DataFrame:
    """(path, depth) of files called `name` at depth 0 to `depth` below root, nearest first: globs, never a walk of the tree."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for d in range(depth + 1):
        pattern = hadoop.Path("/".join([root.rstrip("/"), *["*"] * d, name]))
        found += [(str(s.getPath().toString()), d) for s in pattern.getFileSystem(conf).globStatus(pattern) or []]
    return spark.createDataFrame(found, "path string, depth int").orderBy("depth", "path")


def tree_sample(spark: SparkSession, root: str, n: int = 20) -> list[str]:
    """Up to n files below root, for a message when nothing was found; the listing is lazy and stops there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs, out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), []
    if fs.exists(path):
        files = fs.listFiles(path, True)
        while len(out) < n and files.hasNext():
            out.append(files.next().getPath().toString())
    return out


def read_markers(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, value): the folder and first line of marker files that match the pattern."""
    lines = spark.read.option("wholetext", True).text(pattern).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.select(F.regexp_replace("file", r"/[^/]*$", "").alias("path"), F.trim(F.split("value", "\n")[0]).alias("value"))


def read_subset(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Files below path whose names match glob, as (path, length, content)."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)


def process_metrics(lines: DataFrame, column: str = "value") -> DataFrame:
    """CSV lines "name, memory" of a device query -> (name, memory_mb)."""
    parsed = F.from_csv(F.col(column), "name string, memory string", {"ignoreLeadingWhiteSpace": "true"})
    return lines.select(parsed.alias("p")).select("p.name", F.regexp_extract("p.memory", r"\d+", 0).try_cast("int").alias("memory_mb"))


def key_values(metrics: DataFrame) -> DataFrame:
    """Rows of metrics as key=value lines (one column, value)."""
    pairs = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in metrics.columns]
    return metrics.select(F.explode(F.array_compact(F.array(*pairs))).alias("value"))


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet partitioned by columns; rows of a partition are gathered first, so that each has few files, and AQE splits large ones."""
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def append_raw(df: DataFrame, path: str) -> None:
    """Append-only raw output."""
    df.write.mode("append").parquet(path)


def clean_pages(pages: DataFrame) -> DataFrame:
    """(page_id, host, url, text) of raw pages: tags, scripts and styles out, white space folded, query and fragment off the URL."""
    text = F.regexp_replace("html", r"(?is)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>", " ")
    url = F.regexp_replace(F.lower("url"), r"[?#].*$|/+$", "")
    return pages.select("page_id", F.regexp_extract(url, r"^[a-z]+://([^/:]+)", 1).alias("host"), url.alias("url"), F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")).alias("text"))
