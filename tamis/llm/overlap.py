"""Problem 6: the same or nearly the same pair in training and evaluation splits of a build.

Records are normalised, and records with equal words are one class. A class with training rows is cut
into successive chunks of few words, a class with evaluation rows gives every run of as many words.
An edit changes one chunk at most, so of ``k + 1`` chunks one stands unchanged in any class within
``k`` edits: the rarest ``k + 1`` of each class are joined with the runs, and no pair is lost,
however short it is and wherever its edits are. Chunks that stand on no other side of the split count as
edited and leave fewer to look up; chunks that stand everywhere (stock phrases) are hardly ever among
the rarest, and no bucket is capped. Lengths and word counts that no small edit can bridge thin the
candidates out, and an edit distance on the words of both sides decides.

Both sides of a pair must agree, so one is enough to find all candidates: the instruction, or the
response if that is longer and the instruction has under SHORT words or none.

Overlap fractions of records come from content-defined chunks: a rolling hash of the last two words cuts both sides,
digests are joined across the splits of a build, and the lengths of shared chunks are summed by record. Such
chunks can't find the pairs: with one word in eight edited, chunks of some words are all touched too
often, and shorter ones stand everywhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.plans.runtime import cut, spread, written

#: Training rows with fewer words of instruction are found by their response, if that is longer.
SHORT = 8
#: Up to so many candidate rows the scan for their texts is narrowed by a broadcast; beyond, by
#: a join on both sides.
BROADCAST_ROWS = 500_000
#: Words that may be changed, dropped or added on a side: a share of it, and this many at least.
EDITS, LEAST_EDITS = 0.13, 3

#: Greetings and closing words around a text.
GREETINGS = frozenset("hi hello hey ok okay sure well hmm please note dear all there team good day morning so hallo bonjour hola olá привет".split())
CLOSINGS = frozenset("thanks thank you cheers best kind regards bye danke merci gracias obrigado obrigada спасибо a lot in advance".split())
_WORD = re.compile(r"[^\W_]+")
_LEAD = re.compile(r"^\s*(?:(?:hi|hello|hey|ok|okay|sure|well|hmm|please note|note|dear all|good day|good morning|so|hallo|bonjour|hola|olá|привет)\b(?: there| all| team)?[\s,.:!;-]+)+", re.I)
_TAIL = re.compile(r"[\s,.!;:-]+(?:many thanks|thanks|thank you|cheers|best regards|kind regards|regards|bye|danke|merci|gracias|obrigado|obrigada|спасибо)(?: a lot| in advance| so much)?[\s.!]*$", re.I)


class _Hashes(dict):
    """Word to hash, filled as words come; begun anew when it grows."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _Hashes()


def words(text: str | None) -> list[int]:
    """Hashes of the words in lower case, without punctuation, greeting and closing words."""
    if not text:
        return []
    m = _LEAD.match(text)
    if m and m.end() < len(text):
        text = text[m.end() :]
    at = max(0, len(text) - 60)
    m = _TAIL.search(text, at)
    if m and m.start() > 0:
        text = text[: m.start()]
    hashes = _HASH
    return [hashes[w] for w in _WORD.findall(text.lower())]


def edit_distance(a: list[int], b: list[int], most: int) -> int:
    """Word edit distance, or more than ``most``; columns of the matrix are bits."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    i = 0
    while i < len(a) and i < len(b) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    if not a or not b:
        return len(a) + len(b)
    where: dict[int, int] = {}
    for i, t in enumerate(a):
        where[t] = where.get(t, 0) | 1 << i
    mask, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, d = mask, 0, len(a)
    for t in b:
        eq = where.get(t, 0)
        x = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(x | up) & mask, up & x
        d += bool(plus & top) - bool(minus & top)
        plus = plus << 1 | 1
        up = (minus << 1 | ~((eq | down) | plus)) & mask
        down = plus & (eq | down) & mask
    return d


def most_edits(a: int, b: int) -> int:
    """Words in which sides of so many words may differ: about one in ten."""
    if min(a, b) <= 2 * LEAST_EDITS:
        return max(a, b) // 4
    return max(LEAST_EDITS, int(EDITS * max(a, b)))


def near(a: list[int], b: list[int]) -> bool:
    """At most about one word in ten differs."""
    most = most_edits(len(a), len(b))
    return edit_distance(a, b, most) <= most


@lru_cache(maxsize=100_000)
def reach(n: int) -> int:
    """Edits that a side of ``n`` words may be away from any other."""
    return max(most_edits(n, m) for m in range(n, n + n // 3 + LEAST_EDITS + 1) if m - n <= most_edits(n, m))


def width(n: int) -> int:
    """Words of a chunk of a side of ``n`` words: short enough for more than ``reach(n)`` chunks."""
    return 3 if n >= 12 else 2 if n >= 8 else 1


@lru_cache(maxsize=100_000)
def widths(n: int) -> tuple[int, ...]:
    """Chunk widths of all sides that a side of ``n`` words can be near to."""
    return tuple(sorted({width(m) for m in range(n // 2, 2 * n + 1) if abs(n - m) <= most_edits(n, m)}))


#: Words of instruction up to which an evaluation row can be near to a training row under SHORT.
NEAR_SHORT = max(n + reach(n) for n in range(SHORT))


def runs(sides: list[list[int]], words: int, step: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, digest) of the runs of so many words that begin at every ``step``-th word."""
    size = np.array([len(s) for s in sides], np.int64)
    n = int(size.sum())
    if n < words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.fromiter((w for s in sides for w in s), np.uint64, n)
    seq = np.repeat(np.arange(len(sides)), size)
    place = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
    at = np.flatnonzero((place % step == 0) & (place + words <= size[seq]))
    x = np.full(len(at), salt * 8 + words, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(words):
            x = (x ^ h[at + i]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
    return seq[at], x.view(np.int64)


def probe_keys(ins: list[list[int]], res: list[list[int]], ev: list[bool]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(record, digest) of every record, once each, and the edits its chunks may be away: chunks of
    training records, all runs of evaluation records."""
    parts, edits = [], []
    jobs: dict[tuple[int, int, int], list[int]] = {}
    for k, (i, r, e) in enumerate(zip(ins, res, ev)):
        side = int(len(i) < SHORT and len(r) > len(i))
        n = len(r) if side else len(i)
        edits.append(reach(n))
        if not e:
            jobs.setdefault((side, width(n), width(n)), []).append(k)
            continue
        for w in widths(len(i)):
            jobs.setdefault((0, w, 1), []).append(k)
        for w in widths(len(r)) if len(i) <= NEAR_SHORT else ():
            jobs.setdefault((1, w, 1), []).append(k)
    for (side, w, step), at in jobs.items():
        seq, digest = runs([(res if side else ins)[k] for k in at], w, step, side)
        parts.append(np.stack([np.array(at, np.int64)[seq], digest]))
    both = np.unique(np.concatenate(parts, axis=1), axis=1) if parts else np.empty((2, 0), np.int64)
    return both[0], both[1], edits


#: A chunk ends where the rolling hash of the last ROLL words is 0 modulo MEAN, so after MEAN words on average.
ROLL, MEAN = 2, 6
#: Share of its words that a record must have in common with training records to be reported as mostly shared.
MOSTLY = 0.8


def cut_chunks(sides: list[list[int]], salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, digest, words) of the content-defined chunks of each sequence. Where a cut is depends on ROLL words only,
    so an edit changes the chunks around it and no others."""
    size = np.array([len(s) for s in sides], np.int64)
    n = int(size.sum())
    if not n:
        return (np.empty(0, np.int64),) * 3
    h = np.fromiter((w for s in sides for w in s), np.uint64, n)
    seq = np.repeat(np.arange(len(sides)), size)
    place = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        roll = h.copy()
        for k in range(1, ROLL):
            roll[k:] += np.where(place[k:] >= k, h[:-k] * np.uint64(0x9E3779B97F4A7C15 + 2 * k), np.uint64(0))
        roll ^= roll >> np.uint64(31)
        ends = (roll % np.uint64(MEAN) == 0) & (place >= ROLL - 1) | (place == size[seq] - 1)
        starts = np.flatnonzero(np.concatenate([[True], ends[:-1]]))
        length = np.diff(np.append(starts, n))
        # A digest mixes each word with its place in the chunk.
        inner = np.arange(n) - np.repeat(starts, length)
        x = (h ^ (inner.astype(np.uint64) + np.uint64(salt + 1)) * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        digest = np.add.reduceat(x * np.uint64(0x165667B19E3779F9), starts)
    return seq[starts], digest.view(np.int64), length


#: What a record is told apart by: words of both sides, and their word counts by bucket as rows of bits
#: in numbers, 16 buckets of up to 4 for the instruction, 32 of up to 4 for the response.
SKETCH = ["il", "rl", "w1", "w2", "w3"]


def counts(sides: list[list[int]], buckets: int, most: int = 4) -> tuple[np.ndarray, ...]:
    """Words of each sequence, and its counts by bucket in unary, 64 bits to a number: the bits in which
    two sequences differ are at most the differences of their counts."""
    n, size = len(sides), np.array([len(s) for s in sides], np.int64)
    flat = np.fromiter((w for s in sides for w in s), np.uint64, int(size.sum()))
    at = np.repeat(np.arange(n), size) * buckets + (flat >> np.uint64(40)).astype(np.int64) % buckets
    each = np.minimum(np.bincount(at, minlength=n * buckets), most).reshape(n, buckets)
    bits = each[:, :, None] > np.arange(most)
    packed = np.packbits(bits.reshape(n, buckets * most), axis=1).view(np.int64).reshape(n, -1)
    return size.astype(np.int32), *(np.ascontiguousarray(c) for c in packed.T)


def _records(pairs: DataFrame) -> DataFrame:
    """One row per pair with build and split: class of equal words, distinct digests of its chunks
    (training rows) or runs (others), edits they may be away, and the sketches of both sides."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            ins = [words(t) for t in b.column("instruction").to_pylist()]
            res = [words(t) for t in b.column("response").to_pylist()]
            n = len(ins)
            cls = [xxhash.xxh3_64_intdigest(np.array([len(i), *i, *r], np.uint64).tobytes()) - (1 << 63) for i, r in zip(ins, res)]
            seq, digest, edits = probe_keys(ins, res, b.column("ev").to_pylist())
            own = pa.ListArray.from_arrays(pa.array(np.searchsorted(seq, np.arange(n + 1)), pa.int32()), pa.array(digest, pa.int64()))
            (il, w1), (rl, w2, w3) = counts(ins, 16), counts(res, 32)
            yield pa.RecordBatch.from_arrays(
                [b.column("ord"), b.column("build"), b.column("ev"), pa.array(cls, pa.int64()), own, pa.array(edits, pa.int32()), *map(pa.array, (il, rl, w1, w2, w3))],
                ["ord", "build", "ev", "cls", "digests", "edits", *SKETCH],
            )

    src = pairs.where("build is not null and split is not null").select("ord", F.xxhash64("build").alias("build"), (F.col("split") != "train").alias("ev"), "instruction", "response")
    return spread(src).mapInArrow(run, "ord bigint, build bigint, ev boolean, cls bigint, digests array<bigint>, edits int, il int, rl int, w1 bigint, w2 bigint, w3 bigint")


def near_classes(pairs: DataFrame, recs: DataFrame) -> DataFrame:
    """``build, cls, cls2``: classes that are nearly the same, the first with training rows, the
    second with evaluation rows."""
    import pyarrow as pa

    # One row per class and build; copies on one side of the split carry the same digests.
    of = lambda side: F.first(F.when(side, F.col("digests")), ignorenulls=True)
    classes = written(recs.groupBy("build", "cls").agg(F.min("ord").alias("rep"), of(~F.col("ev")).alias("chunks"), of(F.col("ev")).alias("runs"), *[F.first(c).alias(c) for c in ("edits", *SKETCH)]))
    # A digest counts within its build only.
    digests = lambda of, *keep: classes.select("build", "rep", *keep, F.explode(of).alias("d")).withColumn("d", F.xxhash64("build", "d")).drop("build")
    chunk, run_ = digests("chunks"), digests("runs", *SKETCH)
    counted = chunk.select("d", F.lit(1).alias("t")).union(run_.select("d", F.lit(0))).groupBy("d").agg(F.sum("t").alias("nt"), F.count("*").alias("m"))
    both = counted.where("nt > 0 and m > nt").select("d", (F.col("nt") * (F.col("m") - F.col("nt"))).alias("df"))
    held = chunk.join(both, "d").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "d"))).alias("s"))
    # Chunks that no evaluation row has are edited for sure; one of so many others is whole in a near class.
    left = F.col("edits") + 1 - (F.size("chunks") - F.size("s"))
    probes = classes.drop("runs").join(held, "rep").withColumn("left", left).where("left > 0")
    a = probes.select("rep", *SKETCH, F.explode(F.slice("s", F.lit(1), F.col("left"))).alias("x")).select("rep", *SKETCH, F.col("x.d").alias("d"))
    b = run_.select("d", *[F.col(c).alias(c + "_") for c in ("rep", *SKETCH)])
    most = lambda x, y: F.greatest(F.lit(LEAST_EDITS), F.floor(F.greatest(x, y) * EDITS))
    # A changed word moves two counts by one, so no pair within the bounds is lost here.
    apart = lambda *w: sum((F.bit_count(F.col(x).bitwiseXOR(F.col(x + "_"))) for x in w), F.lit(0))
    fits = (F.col("rep") != F.col("rep_")) & (F.abs(F.col("il") - F.col("il_")) <= most("il", "il_")) & (apart("w1") <= 2 * most("il", "il_")) & (F.abs(F.col("rl") - F.col("rl_")) <= most("rl", "rl_")) & (apart("w2", "w3") <= 2 * most("rl", "rl_"))
    cands = cut(a.join(b, "d").where(fits).select(F.col("rep").alias("ord"), F.col("rep_").alias("ord2")).distinct())
    wanted = cut(cands.select("ord").union(cands.select("ord2")).distinct())
    few = wanted.count() <= BROADCAST_ROWS
    some = cut(pairs.select("ord", "instruction", "response").join(F.broadcast(wanted) if few else wanted, "ord", "left_semi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i1, r1, i2, r2 = ([words(t) for t in b.column(k).to_pylist()] for k in ("i1", "r1", "i2", "r2"))
            ok = [near(i1[k], i2[k]) and near(r1[k], r2[k]) for k in range(b.num_rows)]
            yield b.select(["ord", "ord2"]).filter(pa.array(ok, pa.bool_()))

    full = cands.join(some.toDF("ord", "i1", "r1"), "ord").join(some.toDF("ord2", "i2", "r2"), "ord2")
    ok = full.select("ord", "ord2", "i1", "r1", "i2", "r2").mapInArrow(run, "ord bigint, ord2 bigint")
    c1 = classes.select(F.col("rep").alias("ord"), "build", "cls")
    c2 = classes.select(F.col("rep").alias("ord2"), F.col("cls").alias("cls2"))
    return ok.join(c1, "ord").join(c2, "ord2").select("build", "cls", "cls2")


def cross_split(pairs: DataFrame) -> DataFrame:
    """``ord_a, ord_b`` (ord_a < ord_b) of the same or nearly the same pairs, one in train and the
    other in another split of one build.

    Rows with null build or split are left out; null and empty sides equal each other; repeated
    rows are rows of their own. Each pair of rows comes out once.
    """
    recs = written(_records(pairs))
    members = recs.select("build", "cls", "ord", "ev")
    tr, ev = members.where("not ev").drop("ev"), members.where("ev").select("build", F.col("cls").alias("cls2"), F.col("ord").alias("ord2"))
    same = tr.join(ev.withColumnRenamed("cls2", "cls"), ["build", "cls"]).select("ord", "ord2")
    like = near_classes(pairs, recs).join(tr, ["build", "cls"]).join(ev, ["build", "cls2"]).select("ord", "ord2")
    return same.unionByName(like).select(F.least("ord", "ord2").alias("ord_a"), F.greatest("ord", "ord2").alias("ord_b"))


def overlap_fractions(pairs: DataFrame) -> DataFrame:
    """``ord, build, split, source_id, words, shared``: for every row of a split other than train, its words on both sides and
    how many of them lie in content-defined chunks that stand on the same side of some training row of its build.

    Rows with null build or split are left out; rows without words have zeros; repeated rows count each. Every
    training digest is one row before the join, so a chunk that stands in a third of all rows meets one partner.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, parts = b.num_rows, []
            total = np.zeros(n, np.int64)
            for salt, c in enumerate(("instruction", "response")):
                sides = [words(t) for t in b.column(c).to_pylist()]
                total += np.array([len(x) for x in sides], np.int64)
                parts.append(cut_chunks(sides, salt))
            seq, digest, length = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(seq, kind="stable")
            off = pa.array(np.searchsorted(seq[order], np.arange(n + 1)), pa.int32())
            chunks = [pa.ListArray.from_arrays(off, pa.array(x[order], t)) for x, t in ((digest, pa.int64()), (length, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("ord", "key", "ev", "build", "split", "source_id")), pa.array(total), *chunks], ["ord", "key", "ev", "build", "split", "source_id", "words", "digests", "lengths"])

    src = pairs.where("build is not null and split is not null").select("ord", F.xxhash64("build").alias("key"), (F.col("split") != "train").alias("ev"), F.when(F.col("split") != "train", F.col("build")).alias("build"), F.when(F.col("split") != "train", F.col("split")).alias("split"), F.when(F.col("split") != "train", F.col("source_id")).alias("source_id"), "instruction", "response")
    kinds = {c: pairs.schema[c].dataType.simpleString() for c in ("ord", "source_id")}
    recs = written(spread(src).mapInArrow(run, f"ord {kinds['ord']}, key bigint, ev boolean, build string, split string, source_id {kinds['source_id']}, words bigint, digests array<bigint>, lengths array<int>"))
    mark = lambda d: F.xxhash64("key", d).alias("d")
    train = recs.where("not ev").select("key", F.explode("digests").alias("x")).select(mark("x")).distinct()
    held = recs.where("ev").select("ord", "key", F.explode(F.arrays_zip("digests", "lengths")).alias("x")).select("ord", mark("x.digests"), F.col("x.lengths").alias("n"))
    shared = held.join(train, "d", "left_semi").groupBy("ord").agg(F.sum("n").alias("shared"))
    return recs.where("ev").select("ord", "build", "split", "source_id", "words").join(shared, "ord", "left").withColumn("shared", F.coalesce("shared", F.lit(0)).cast("long"))


def overlap_report(pairs: DataFrame) -> DataFrame:
    """By build, split and source_id: evaluation rows, those that are the same or nearly the same as a training row
    (:func:`cross_split`), those of which MOSTLY the words are shared with training rows, and the shared fraction of all words
    (null without words). Groups without any overlap are in it too."""
    found = cross_split(pairs)
    each = found.select(F.col("ord_a").alias("ord")).union(found.select("ord_b")).distinct().withColumn("near", F.lit(1))
    rows = overlap_fractions(pairs).join(each, "ord", "left")
    mostly = (F.col("words") > 0) & (F.col("shared") >= MOSTLY * F.col("words"))
    return rows.groupBy("build", "split", "source_id").agg(F.count("*").alias("rows"), F.count("near").alias("near_rows"), F.count_if(mostly).alias("mostly_shared"), F.round(F.try_divide(F.sum("shared"), F.sum("words")), 4).alias("shared_fraction"))
