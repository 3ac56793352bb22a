"""MinHash signatures and greedy near-duplicate elimination without false negatives."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.plans.runtime import cut, spread

log = logging.getLogger(__name__)

PERMUTATIONS, SHINGLE = 64, 5
PRIME = (1 << 61) - 1


def coefficients(n: int = PERMUTATIONS, seed: int = 1) -> tuple[list[int], list[int]]:
    """Multipliers, then increments, of a linear congruential generator."""
    state, out = (seed & 0xFFFFFFFF) or 1, []
    for _ in range(2 * n):
        state = (1103515245 * state + 12345) & 0x7FFFFFFF
        out.append(state)
    return [a or 1 for a in out[:n]], out[n:]


def signature_of(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum over the hashes of (a h + b) mod 2^61 - 1, for each a, b; zeros without hashes.

    The product of 31 and 64 bits is taken in two halves; multiplying by 2^30 modulo
    2^61 - 1 is a rotation of 61 bits.
    """
    if not len(hashes):
        return np.zeros(len(a), np.int64)
    p = np.uint64(PRIME)
    h = hashes % p
    hi, lo = h >> np.uint64(30), h & np.uint64((1 << 30) - 1)
    x = (a[:, None] * hi[None, :]) % p
    x = ((x << np.uint64(30)) & p) | (x >> np.uint64(31))
    x = (x + (a[:, None] * lo[None, :]) % p) % p
    return ((x + b[:, None]) % p).min(axis=1).astype(np.int64)


def signatures(docs: DataFrame, hash_: str = "blake2b", permutations: int = PERMUTATIONS, shingle: int = SHINGLE, seed: int = 1) -> DataFrame:
    """``ord, sig`` of ``docs(ord, text)``; ``hash_`` is blake2b or sha256 (first 8 bytes, big end).
    Null texts and texts without words have a signature of zeros."""
    import pyarrow as pa

    kind = docs.schema["ord"].dataType.simpleString()
    ca, cb = coefficients(permutations, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import re

        word = re.compile(r"\w+").findall
        a, b = np.array(ca, np.uint64), np.array(cb, np.uint64)
        digest = (lambda g: hashlib.blake2b(g, digest_size=8).digest()) if hash_ == "blake2b" else (lambda g: hashlib.sha256(g).digest()[:8])

        def one(text: str | None) -> np.ndarray:
            w = word(text.lower()) if text else []
            grams = {" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else ({" ".join(w)} if w else set())
            raw = b"".join(digest(g.encode("utf-8", "surrogatepass")) for g in grams)
            hashes = np.frombuffer(raw, ">u8").astype(np.uint64)
            best = None
            for i in range(0, len(hashes), 4096):  # long texts in blocks
                s = signature_of(hashes[i : i + 4096], a, b)
                best = s if best is None else np.minimum(best, s)
            return signature_of(hashes, a, b) if best is None else best

        for batch in batches:
            sigs = [one(t) for t in batch.column(1).to_pylist()]
            flat = np.concatenate(sigs) if sigs else np.empty(0, np.int64)
            off = pa.array(np.arange(len(sigs) + 1, dtype=np.int32) * permutations)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(off, pa.array(flat, pa.int64()))], ["ord", "sig"])

    return spread(docs.select("ord", "text")).mapInArrow(run, f"ord {kind}, sig array<bigint>")


def equal_places(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def similarity(a: Column, b: Column) -> Column:
    """Share of equal places of two signatures; 0 for empty ones."""
    return F.when(F.size(a) == 0, F.lit(0.0)).otherwise(equal_places(a, b) / F.size(a))


def least_equal(threshold: float, permutations: int = PERMUTATIONS) -> int:
    """The least number of equal places that reaches the threshold."""
    return next(k for k in range(permutations + 1) if k / permutations >= threshold)


def band_plan(threshold: float, permutations: int = PERMUTATIONS) -> tuple[int, int]:
    """Number of bands, and in how many of them two signatures that reach the threshold may differ: bands are twice as
    many as the least power of two that leaves some of them equal, so that several must be."""
    apart = permutations - least_equal(threshold, permutations)
    n = 1
    while n < min(permutations, 1.5 * apart + 1):
        n *= 2
    return min(n, permutations), apart


def bands(sig: Column, threshold: float, permutations: int = PERMUTATIONS) -> Column:
    """Keys of disjoint bands of a signature."""
    n, _ = band_plan(threshold, permutations)
    edges = [round(i * permutations / n) for i in range(n + 1)]
    return F.array(*[F.xxhash64(F.lit(i), F.slice(sig, edges[i] + 1, edges[i + 1] - edges[i])) for i in range(n)])


def buckets(reps: DataFrame, threshold: float) -> DataFrame:
    """``ord, k`` such that two rows of ``reps(ord, sig)`` that reach the threshold share a ``k``.

    Of ``n`` bands they differ in at most ``m``. In the common order from rare to frequent, one of the ``m + 1``
    rarest bands of each is among those that both have: only these are kept, so a band that a third of all rows have
    is hardly ever a bucket. Bands that stand alone count as different and leave fewer to keep.
    """
    n, m = band_plan(threshold)
    keyed = reps.select("ord", F.explode(bands(F.col("sig"), threshold)).alias("k"))
    shared = keyed.groupBy("k").agg(F.count("*").alias("df")).where("df > 1")
    held = keyed.join(shared, "k").groupBy("ord").agg(F.sort_array(F.collect_list(F.struct("df", "k"))).alias("s"))
    left = F.lit(m + 1 - n) + F.size("s")
    return held.where(left > 0).select("ord", F.explode(F.slice("s", F.lit(1), left)).alias("x")).select("ord", "x.k")


def _settled(fronts: DataFrame, edges: DataFrame) -> tuple[DataFrame, int]:
    """``ord, kept`` of what ``edges(ord, head)`` (similar, ``head`` earlier) decide of the rows: one of ``fronts(ord)``, of which all
    earlier similar rows are among its edges, is kept when these are all dropped, and every row with an edge to a kept one is
    dropped. Also the number of steps."""
    done, open_, live, steps = None, fronts, edges, 0
    while True:
        kept = cut(open_.join(live.select("ord").distinct(), "ord", "left_anti"))
        if kept.isEmpty():
            return done if done is not None else kept.withColumn("kept", F.lit(True)), steps
        dropped = cut(live.join(kept.select(F.col("ord").alias("head")), "head", "left_semi").select("ord").distinct())
        new = kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False)))
        done, steps = new if done is None else done.unionByName(new), steps + 1
        # Edges of and to dropped rows say nothing more.
        live = cut(live.join(dropped, "ord", "left_anti").join(dropped.select(F.col("ord").alias("head")), "head", "left_anti"))
        open_ = open_.join(new.select("ord"), "ord", "left_anti")
        if live.isEmpty():
            rest = open_.withColumn("kept", F.lit(True))
            return done.unionByName(rest), steps


def greedy_near_duplicates(docs: DataFrame, threshold: float = 0.85, hash_: str = "blake2b", heads: int = 16) -> DataFrame:
    """``ord`` of documents that a scan in order would drop: similar to an earlier kept one.

    Equal signatures collapse to their first document. Of the rest, each round compares the members of every bucket with its
    first ``heads`` documents, never all pairs of a bucket. A document that is among the first in all its buckets has
    met all earlier ones that it could be similar to, so the similar pairs found decide it; what is decided leaves, and
    the next round goes on until every bucket is spent. Needs 0 < threshold <= 1.
    """
    from pyspark.sql import Window

    sigs = cut(signatures(docs, hash_))
    first = cut(sigs.groupBy("sig").agg(F.min("ord").alias("first")))
    copies = sigs.join(first, "sig").where("ord <> first").select("ord")
    need = least_equal(threshold)
    reps = first.select(F.col("first").alias("ord"), "sig")
    if need == PERMUTATIONS:
        return copies
    crowded = lambda b: cut(b.join(b.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k"), "k"))
    left, gone, rounds, steps = crowded(buckets(reps, threshold)), None, 0, 0
    while not left.isEmpty():
        # The limit on the rank is taken before the shuffle too, so a large bucket sends few rows.
        rank = F.row_number().over(Window.partitionBy("k").orderBy("ord"))
        front = cut(left.withColumn("r", rank).where(F.col("r") <= heads).select("k", F.col("ord").alias("head")))
        last = front.groupBy("k").agg(F.max("head").alias("last"))
        fronts = cut(left.join(last, "k").groupBy("ord").agg(F.bool_and(F.col("ord") <= F.col("last")).alias("ok")).where("ok").select("ord"))
        met = left.join(front, "k").where("head < ord").select("ord", "head").distinct()
        a, b = reps.toDF("ord", "s1"), reps.toDF("head", "s2")
        edges = cut(met.join(a, "ord").join(b, "head").where(equal_places(F.col("s1"), F.col("s2")) >= need).select("ord", "head"))
        done, n = _settled(fronts, edges)
        done, rounds, steps = cut(done), rounds + 1, steps + n
        dropped = done.where("not kept").select("ord")
        gone = dropped if gone is None else gone.unionByName(dropped)
        left = crowded(left.join(done.select("ord"), "ord", "left_anti"))
    log.info("near-duplicates: %d rounds, %d steps", rounds, steps)
    return copies if gone is None else copies.unionByName(gone)
