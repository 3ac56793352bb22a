"""Document cleaning: ordered filters, the first that applies names the drop reason."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import text as T
from tamis.functions.redact import scrub
from tamis.operators.minhash import greedy_near_duplicates
from tamis.plans.runtime import spread, written

#: Licences that a document may carry.
LICENSES = ["MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause-Clear", "ISC", "0BSD", "Unlicense", "Zlib", "MPL-2.0", "BSL-1.0", "PostgreSQL", "CC0-1.0", "WTFPL"]
#: Parts of paths that are left out.
EXCLUDES = ["vendor/", "node_modules/", ".git/", "mocks/", "testdata/", "_test.go", "mock_", ".pb.go", "_string.go"]
EXTENSIONS = [".go"]
REASONS = ["encoding", "license", "length", "exact_duplicate", "near_duplicate"]


@dataclass(frozen=True)
class CleanOptions:
    """Bounds are inclusive; empty lists mean the defaults."""

    min_length: int = 50
    max_length: int = 100_000
    licenses: list[str] = field(default_factory=list)
    allow_unknown_license: bool = True
    near_threshold: float = 0.85
    scrub: bool = True
    min_printable: float = 0.85
    #: Hash of the shingles: blake2b or sha256.
    hash: str = "blake2b"


def wanted_path(path: Column, extensions: list[str] | None = None, excludes: list[str] | None = None) -> Column:
    """Forward-slashed path ends with an extension and holds no excluded part."""
    p = F.translate(path, "\\", "/")
    ends, holds = F.lit(False), F.lit(False)
    for e in extensions or EXTENSIONS:
        ends = ends | p.endswith(e)
    for x in excludes or EXCLUDES:
        holds = holds | p.contains(x)
    return ends & ~holds


def allowed_license(license_: Column, allowed: list[str] | None = None, unknown: bool = True) -> Column:
    """Null is unknown; an empty text isn't, and is no licence."""
    return F.when(license_.isNull(), F.lit(unknown)).otherwise(license_.isin(allowed or LICENSES))


def filtered(docs: DataFrame, o: CleanOptions = CleanOptions(), content: str = "content", license_: str | None = "license") -> DataFrame:
    """``docs`` with redacted content, ``redactions`` and ``drop_reason`` of the row filters.

    Redactions are counted for rows that reach that stage, so not for encoding and licence drops.
    """
    known = allowed_license(F.col(license_), o.licenses, o.allow_unknown_license) if license_ else F.lit(o.allow_unknown_license)
    early = F.when(T.printable_ratio(F.col(content)) < o.min_printable, "encoding").when(~known, "license")
    out = spread(docs).withColumn("drop_reason", early)
    if o.scrub:
        out = scrub(out.withColumn("__c", F.when(F.col("drop_reason").isNull(), F.col(content))), "__c")
        out = out.withColumn(content, F.coalesce("__c", content)).drop("__c")
    else:
        out = out.withColumn("redactions", F.lit(0).cast("long"))
    return out.withColumn("drop_reason", F.coalesce("drop_reason", F.when(~F.length(content).between(o.min_length, o.max_length), "length")))


def exact_marked(docs: DataFrame, order: str, content: str = "content") -> DataFrame:
    """``docs`` with ``content_hash`` and with later copies marked ``exact_duplicate``; rows that
    already have a reason claim no hash.

    The first row of each hash comes from an aggregation with map-side combine, joined back, so
    a content that makes up a third of all rows doesn't land in one task as a window would.
    """
    out = docs.withColumn("content_hash", F.when(F.col("drop_reason").isNull(), F.sha2(content, 256)))
    first = out.where("content_hash is not null").groupBy(F.col("content_hash").alias("__h")).agg(F.min(order).alias("__first"))
    out = out.join(first, F.col("content_hash") == F.col("__h"), "left")
    return out.withColumn("drop_reason", F.when(F.col("drop_reason").isNull() & (F.col(order) != F.col("__first")), "exact_duplicate").otherwise(F.col("drop_reason"))).drop("__h", "__first")


def clean(docs: DataFrame, order: str = "ord", o: CleanOptions = CleanOptions(), content: str = "content", license_: str | None = "license") -> DataFrame:
    """All rows with ``redactions``, ``content_hash`` and ``drop_reason``; kept rows have a null
    reason. ``order`` is a unique key; the first in order wins.

    Null and empty content is ``encoding``. A threshold above 1 leaves out the near stage; at or
    below 0 it keeps the first row only. An empty table gives no rows.
    """
    # Both branches of the exact stage read the redacted texts; they are written once.
    out = exact_marked(written(filtered(docs, o, content, license_)), order, content)
    if o.near_threshold > 1:
        return out
    out = written(out)
    live = out.where("drop_reason is null")
    if o.near_threshold <= 0:
        first = live.agg(F.min(order).alias("__m"))
        return out.join(first, F.lit(True), "left").withColumn("drop_reason", F.when(F.col("drop_reason").isNull() & (F.col(order) != F.col("__m")), "near_duplicate").otherwise(F.col("drop_reason"))).drop("__m")
    near = greedy_near_duplicates(live.select(F.col(order).alias("ord"), F.col(content).alias("text")), o.near_threshold, o.hash)
    out = out.join(near.select(F.col("ord").alias("__near")), F.col(order) == F.col("__near"), "left")
    return out.withColumn("drop_reason", F.when(F.col("__near").isNotNull(), "near_duplicate").otherwise(F.col("drop_reason"))).drop("__near")


def kept(cleaned: DataFrame) -> DataFrame:
    return cleaned.where("drop_reason is null").drop("drop_reason", "redactions")


def clean_stats(cleaned: DataFrame) -> DataFrame:
    """One row of counters; redactions count also for rows dropped after that stage."""
    r = F.col("drop_reason")
    return cleaned.agg(
        F.count("*").alias("total_in"),
        F.count_if(r.isNull()).alias("total_out"),
        *[F.count_if(r == x).alias(x) for x in REASONS],
        F.coalesce(F.sum("redactions"), F.lit(0)).cast("long").alias("redactions"),
    )


def first_of_each(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by ``order`` (incremental exact deduplication), an aggregation with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(order))
    return df.groupBy(*keys).agg(row.alias("__x")).select(*keys, "__x.*").select(*df.columns)
