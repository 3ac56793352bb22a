"""Stage files between the commands: JSON lines, one JSON list, or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _is_list(spark: SparkSession, path: str) -> bool:
    """A file that begins with ``[``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.getFileStatus(p).isFile():
        return False
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(256)).lstrip(b"\xef\xbb\xbf \t\r\n").startswith(b"[")
    finally:
        stream.close()


def read_stage(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table (by its ending), one JSON list over several lines, or JSON lines in a file or folder. A schema saves the
    scan that finds one."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("multiLine", _is_list(spark, path)).json(path)


def write_stage(df: DataFrame, path: str) -> None:
    """A Parquet table by its ending, else a folder of JSON lines, written in parallel."""
    w = df.write.mode("overwrite")
    w.parquet(path) if path.rstrip("/").endswith(".parquet") else w.option("ignoreNullFields", False).json(path)
