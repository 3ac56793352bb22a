"""Problem 5: at most a share of each build per contributor, best judged rows first.

One global range sort by build, contributor and falling score gives every row its exact
position: partition counts are prefix-summed on the driver (a few numbers per partition, never
rows), and a run that crosses a partition border takes its start from the partition where it
began. So no contributor is gathered in one task, however large.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions.ids import norm_id
from tamis.plans.runtime import cut

#: Share of a build's rows that one contributor keeps, in percent.
PERCENT = 4


def latest_score(verdicts: DataFrame) -> DataFrame:
    """``pair_ord, score`` of the latest verdict of each pair by judged_at; equal times: the
    larger ord. Rows without pair_ord are left out."""
    v = verdicts.where("pair_ord is not null").groupBy("pair_ord").agg(F.max(F.struct("judged_at", "ord", "score")).alias("v"))
    return v.select("pair_ord", F.col("v.score").alias("score"))


def ranked(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``rows`` with ``rank``, the position from 0 of each row within ``keys`` (which are long
    columns without nulls) under ``order``, by one range sort."""
    import pyarrow as pa

    by = [*map(F.col, keys), *order]
    table = cut(rows.repartitionByRange(*by).sortWithinPartitions(*by))
    names, fields = table.columns, table.schema

    def whole(batches: Iterator[pa.RecordBatch]):
        got = [b for b in batches if b.num_rows]
        return pa.Table.from_batches(got) if got else None

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per partition: its first and last key, rows, and rows before the last run."""
        import numpy as np
        from pyspark import TaskContext

        n, first, last, start = 0, None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in keys])
            if first is None:
                first = k[:, 0].tolist()
            change = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0))
            head = k[:, 0].tolist()
            if head != last:
                start = n
            if len(change):
                start = n + int(change[-1]) + 1
            last = k[:, -1].tolist()
            n += b.num_rows
        if n:
            yield pa.RecordBatch.from_pylist([{"p": TaskContext.get().partitionId(), "first": first, "last": last, "n": n, "start": start}], schema=pa.schema([("p", pa.int32()), ("first", pa.list_(pa.int64())), ("last", pa.list_(pa.int64())), ("n", pa.int64()), ("start", pa.int64())]))

    # One row per partition reaches the driver.
    info = sorted(table.select(*keys).mapInArrow(runs, "p int, first array<bigint>, last array<bigint>, n bigint, start bigint").collect(), key=lambda r: r.p)
    offset, carried, before = {}, {}, 0
    open_key, open_start = None, 0
    for r in info:
        offset[r.p] = before
        carried[r.p] = open_start if open_key == list(r.first) else before
        begun_here = not (r.start == 0 and open_key == list(r.last))
        if begun_here:
            open_key, open_start = list(r.last), before + r.start
        before += r.n

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        p, n, last, start = TaskContext.get().partitionId(), 0, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if last is None:
                start = carried[p]
            k = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in keys])
            pos = offset[p] + n + np.arange(b.num_rows)
            new = np.concatenate([[last is not None and k[:, 0].tolist() != last], (k[:, 1:] != k[:, :-1]).any(axis=0)])
            starts = np.maximum.accumulate(np.where(new, pos, start))
            start, last = int(starts[-1]), k[:, -1].tolist()
            n += b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pos - starts, pa.int64())], [*names, "rank"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", rank bigint"
    return table.mapInArrow(place, ddl)


def over_cap(pairs: DataFrame, verdicts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``ord`` of the pairs to drop.

    Null builds are left out. Null and blank source_id count in the build but are never dropped.
    Null scores, NaN scores and pairs without a verdict come last, ties go by smaller ord;
    repeated rows count like others. Empty tables give no rows.
    """
    p = pairs.where("build is not null").select("ord", F.xxhash64("build").alias("b"), norm_id(F.col("source_id")).alias("s"))
    caps = p.groupBy("b").agg(F.floor((F.count("*") * percent + 99) / 100).cast("long").alias("cap"))
    p = p.where("s is not null").select("ord", "b", F.xxhash64("s").alias("c"))
    scored = p.join(latest_score(verdicts), p["ord"] == F.col("pair_ord"), "left").select("b", "c", "ord", F.coalesce(F.nanvl("score", F.lit(None).cast("double")), F.lit(float("-inf"))).alias("score"))
    r = ranked(scored, ["b", "c"], [F.col("score").desc(), F.col("ord")])
    return r.join(caps, "b").where("rank >= cap").select("ord")
