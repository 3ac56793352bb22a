"""Records of the exported schema, reproducible splits, sinks and the manifest."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.plans.runtime import cut, positions

SYSTEM_PROMPT = "You are a careful programming assistant."
FIELDS = ["instruction", "response", "context", "messages"]


class SchemaError(ValueError):
    """A pair without an instruction or response."""


def records(pairs: DataFrame, keep: list[str] | None = None, system_prompt: str = SYSTEM_PROMPT, on_error: str = "raise") -> DataFrame:
    """``keep`` and the four fields of every pair; a blank side raises when the row is evaluated, or
    with ``on_error='drop'`` drops the row."""
    i, r, c = (T.strip(F.coalesce(F.col(x), F.lit(""))) for x in ("instruction", "response", "context"))
    ok = (i != "") & (r != "")
    if on_error == "drop":
        pairs = pairs.where(ok)
    else:
        i = F.when(ok, i).otherwise(F.raise_error(F.lit("record without instruction or response")))
    user = F.when(F.col("context") == "", F.col("instruction")).otherwise(F.concat("instruction", F.lit("\n\n"), "context"))
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    out = pairs.select(*[F.col(k) for k in keep or []], i.alias("instruction"), r.alias("response"), c.alias("context"))
    return out.withColumn("messages", F.array(turn("system", F.lit(system_prompt)), turn("user", user), turn("assistant", F.col("response"))))


def check_ratio(val_ratio: float) -> None:
    if not 0.0 <= val_ratio < 1.0:
        raise ValueError("val_ratio must be in [0, 1)")


def split(recs: DataFrame, order: str, val_ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """``recs`` with ``split`` and ``pos``, the place in its split.

    The seed shuffles by the order of SHA-256 over seed and key, which is the same at every size and needs no
    list of all records anywhere; the first int(n * ratio) places are validation, the rest are training rows.
    Both depend on keys only, never on partitioning.
    """
    check_ratio(val_ratio)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(order).cast("string")), 256)
    placed = cut(positions(recs, [key, F.col(order)], "__pos"))
    n_val = int(placed.count() * val_ratio)
    val = F.col("__pos") < n_val
    return placed.withColumn("split", F.when(val, "validation").otherwise("train")).withColumn("pos", F.when(val, F.col("__pos")).otherwise(F.col("__pos") - n_val)).drop("__pos")


def split_sizes(recs: DataFrame) -> DataFrame:
    return recs.groupBy("split").agg(F.count("*").alias("records"))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def _one_file(spark: SparkSession, folder: str, target: str) -> None:
    """Renames the only part file of a written folder to ``target``."""
    fs, src, jvm = _fs(spark, folder)
    part = next(s.getPath() for s in fs.listStatus(src) if s.getPath().getName().startswith("part-"))
    dst = jvm.org.apache.hadoop.fs.Path(target)
    fs.delete(dst, False)
    fs.rename(part, dst)
    fs.delete(src, True)


def write_jsonl(recs: DataFrame, path: str, single: bool = True) -> None:
    """One record a line, messages nested, in order of ``pos`` if there is one. ``single`` makes
    one file; without it a folder of part files, as fits large sets."""
    line = F.to_json(F.struct(*[F.col(f) for f in FIELDS])).alias("value")
    if not single:
        recs.select(line).write.mode("overwrite").text(path)
        return
    one = recs.coalesce(1)
    if "pos" in recs.columns:
        one = one.sortWithinPartitions("pos")
    one.select(line).write.mode("overwrite").text(path + ".tmp")
    _one_file(recs.sparkSession, path + ".tmp", path)


def write_parquet(recs: DataFrame, path: str, single: bool = True, nested: bool = False) -> None:
    """Four columns; messages as JSON text unless ``nested``."""
    msg = F.col("messages") if nested else F.to_json("messages").alias("messages")
    cols = [*FIELDS[:3], msg]
    if not single:
        recs.select(*cols).write.mode("overwrite").parquet(path)
        return
    one = recs.coalesce(1)
    if "pos" in recs.columns:
        one = one.sortWithinPartitions("pos")
    one.select(*cols).write.mode("overwrite").parquet(path + ".tmp")
    _one_file(recs.sparkSession, path + ".tmp", path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    schema = "instruction string, response string, context string, messages array<struct<role:string,content:string>>"
    return spark.read.schema(schema).json(path)


def file_entry(spark: SparkSession, path: str, split_name: str, fmt: str, count: int) -> dict:
    """Name, records, size and streamed SHA-256 of a file."""
    fs, p, _ = _fs(spark, path)
    digest, size, stream = hashlib.sha256(), fs.getFileStatus(p).getLen(), fs.open(p)
    try:
        while True:
            chunk = stream.readNBytes(1 << 20)
            if not chunk:
                break
            digest.update(bytes(chunk))
    finally:
        stream.close()
    return {"path": p.getName(), "split": split_name, "format": fmt, "records": count, "bytes": size, "sha256": digest.hexdigest()}


def part_entries(spark: SparkSession, path: str, split_name: str, fmt: str) -> list[dict]:
    """Entries of the part files of a folder; sizes, digests and records are taken in tasks, a file each."""
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    read = spark.read.parquet(path) if fmt == "parquet" else spark.read.text(path)
    rows = read.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).agg(F.count("*").alias("n"))
    got = files.select(name.alias("file"), "length", F.sha2("content", 256).alias("sha256")).join(rows, "file", "left").orderBy("file").collect()
    base = path.rsplit("/", 1)[-1]
    return [{"path": f"{base}/{r.file}", "split": split_name, "format": fmt, "records": r.n or 0, "bytes": r.length, "sha256": r.sha256} for r in got]


def build(pairs: DataFrame, name: str, out: str, order: str = "ord", val_ratio: float = 0.1, seed: int = 42, formats: Iterable[str] = ("jsonl",), stats: dict | None = None, system_prompt: str = SYSTEM_PROMPT, on_error: str = "raise", single: bool = True) -> dict:
    """Writes ``<name>.<split>.<format>`` and ``<name>.manifest.json``; returns the manifest. An empty
    validation split isn't written, an empty training split is. Without ``single`` a split is a folder of part files,
    written in parallel, with an entry for each in the manifest."""
    check_ratio(val_ratio)
    spark = pairs.sparkSession
    done = cut(split(records(pairs, [order], system_prompt, on_error), order, val_ratio, seed))
    sizes = dict(split_sizes(done).collect())
    counts = {"train": sizes.get("train", 0), "validation": sizes.get("validation", 0)}
    files = []
    for s, n in counts.items():
        if not n and s == "validation":
            continue
        part = done.where(F.col("split") == s)
        for fmt, write in (("jsonl", write_jsonl), ("parquet", write_parquet)):
            if fmt in formats:
                path = f"{out}/{name}.{s}.{fmt}"
                write(part, path, single)
                files += [file_entry(spark, path, s, fmt, n)] if single else part_entries(spark, path, s, fmt)
    manifest = {"name": name, "created_at": datetime.now(UTC).isoformat(), "total_records": sum(counts.values()), "splits": counts, "files": files, "schema_fields": FIELDS, "stats": stats or {}}
    fs, p, _ = _fs(spark, f"{out}/{name}.manifest.json")
    f = fs.create(p, True)
    try:
        f.write(bytearray(json.dumps(manifest, indent=2, ensure_ascii=False).encode()))
    finally:
        f.close()
    return manifest


def export_jsonl(pairs: DataFrame, path: str) -> str:
    """All pairs, unsplit, in one file."""
    write_jsonl(records(pairs), path)
    return path
