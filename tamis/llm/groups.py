"""Problem 4: groups of related records, and splits that keep each group together.

Connected components by random-mate contraction: in each round every vertex draws a coin, a
vertex with tails that has a neighbour with heads joins the smallest such neighbour, the edges
are renamed by a SQL join and loops and repeats vanish, until no edge is left. The joins of
all rounds are then unwound from the last to the first. A round needs a fixed number of joins
and a hub is merged in one round whatever its degree, so no group gathers in one task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.functions.ids import norm_id, norm_url, owner_of
from tamis.plans.runtime import cut

#: Names that stand for no author.
NO_AUTHOR = ["", "unknown", "anonymous", "n.n.", "nn", "n.n", "n/a", "na", "none", "null", "nil", "et al.", "et al", "and others", "others", "various", "various authors", "authors", "author", "the authors", "unnamed", "not available", "not specified", "unspecified", "tbd", "tba", "todo", "-", "--", "?", "."]


#: Groups with more than one row in so many are joined by a broadcast.
GIANTS = 1000


def author_key(names: Column) -> Column:
    """Each name without accents, case, commas and order of its parts; null for no author."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def keys(col: pd.Series) -> pd.Series:
        import re
        import unicodedata

        none = set(NO_AUTHOR)

        def one(name: str | None) -> str | None:
            if name is None:
                return None
            flat = "".join(x for x in unicodedata.normalize("NFKD", name) if not unicodedata.combining(x)).casefold()
            for a, b in (("ø", "o"), ("ł", "l"), ("đ", "d"), ("æ", "ae"), ("œ", "oe"), ("ı", "i")):
                flat = flat.replace(a, b)
            if " ".join(flat.split()) in none:
                return None
            parts = sorted(x for x in re.split(r"[\s,;]+", flat) if x)
            return " ".join(parts) if parts and any(c.isalnum() for c in flat) and " ".join(parts) not in none else None

        return col.map(lambda xs: None if xs is None else [k for x in xs if (k := one(x))])

    return keys(names)


def record_links(records: DataFrame) -> DataFrame:
    """``ord, item, keys``: the normalised id and all that links the record, as hashes with the
    item's own first. An id that is null or blank makes the record an item of its own."""
    item = norm_id(F.col("id"))
    own = F.xxhash64(F.lit("item"), F.coalesce(F.col("item"), F.concat(F.lit("\0row "), F.col("ord").cast("string"))))
    flat = records.select("ord", "source", item.alias("item"), norm_url(F.when(F.lower("source") == "github", F.col("fetch_url"))).alias("url"), author_key(F.col("extra.authors")).alias("authors"))
    owner = owner_of(F.col("item"))
    keys = F.array_compact(
        F.concat(
            F.array(
                F.when(owner.isNotNull(), F.xxhash64(F.lit("owner"), owner)),
                F.when(F.col("url").isNotNull(), F.xxhash64(F.lit("url"), F.col("url"))),
            ),
            F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.xxhash64(F.lit("author"), a)),
        )
    )
    return flat.select("ord", "item", own.alias("v"), keys.alias("keys"))


def _coin(v: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), v), F.lit(2)) == 0


def components(edges: DataFrame, seed: int = 1, per_unwind: int = 5) -> DataFrame:
    """``v, root`` of every vertex of ``edges(a, b)`` that isn't its own root.

    Self loops, repeated and reversed edges are harmless, nulls are no edges.
    """
    tidy = lambda e: e.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, rounds, k = cut(tidy(edges)), [], 0
    left = edges.count()
    while left:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        mates = both.where(_coin(F.col("a"), seed * 1000 + k) & ~_coin(F.col("b"), seed * 1000 + k)).groupBy(F.col("b").alias("v")).agg(F.min("a").alias("head"))
        mates = cut(mates)
        x, y = mates.toDF("xa", "xh"), mates.toDF("yb", "yh")
        renamed = edges.join(x, F.col("a") == F.col("xa"), "left").join(y, F.col("b") == F.col("yb"), "left").select(F.coalesce("xh", "a").alias("a"), F.coalesce("yh", "b").alias("b"))
        edges = cut(tidy(renamed))
        rounds.append(mates)
        left, k = edges.count(), k + 1
    found = None
    for i, mates in enumerate(reversed(rounds)):
        if found is None:
            found = mates.toDF("v", "root")
            continue
        late = found.toDF("w", "root")
        found = found.unionByName(mates.join(late, F.col("head") == F.col("w"), "left").select("v", F.coalesce("root", "head").alias("root")))
        if i % per_unwind == 0:
            found = cut(found)
    return found if found is not None else edges.toDF("v", "root").limit(0)


def related(records: DataFrame) -> DataFrame:
    """``ord, group_id`` of every record; ``group_id`` is the smallest normalised id of the group
    in code-point order.

    Missing and placeholder authors and null addresses link nothing, a null or blank id makes a
    group of its own unless an author or address links it (group_id is then the group's
    smallest id, or null), repeated rows are kept, an empty table gives no rows. Only id, source,
    fetch_url and extra.authors are read.
    """
    links = cut(record_links(records))
    edges = links.select(F.col("v").alias("a"), F.explode("keys").alias("b"))
    root = components(edges)
    labelled = links.select("ord", "item", "v").join(root.withColumnRenamed("v", "w"), F.col("v") == F.col("w"), "left").select("ord", "item", F.coalesce("root", "v").alias("g"))
    labelled = cut(labelled)
    smallest = cut(labelled.groupBy("g").agg(F.min("item").alias("group_id"), F.count("*").alias("n")))
    # A group with more than a GIANTS-th of the rows would gather in one task of a join; there are fewer than GIANTS of them.
    giant = F.col("n") * GIANTS > labelled.count()
    few, rest = smallest.where(giant), smallest.where(~giant)
    told = labelled.select("ord", "g").join(F.broadcast(few.select("g", F.col("group_id").alias("big"), F.lit(True).alias("giant"))), "g", "left")
    return told.where("giant").select("ord", F.col("big").alias("group_id")).unionByName(told.where("giant is null").select("ord", "g").join(rest.select("g", "group_id"), "g").select("ord", "group_id"))


def grouped_splits(groups: DataFrame, targets: DataFrame, id_col: str = "ord", seed: int = 1) -> DataFrame:
    """``id_col, group_id, split``: every group whole in one split, shares near ``targets``.

    Groups are laid along a line by the hash of their id, with their sizes as lengths; the
    cumulative weight at a group's middle picks the split. Groups longer than the smallest
    share, of which there are fewer than total shares in it, go one by one, the largest first, to the split with the most room
    left, and the rest is filled up around them.
    ``targets(split, share)`` must have a few rows with positive shares; null shares are left out.
    """
    shares = sorted(((r["split"], float(r["share"])) for r in targets.where("share > 0").limit(1001).collect()), key=lambda x: (-x[1], x[0]))
    if not shares or len(shares) > 1000:
        raise ValueError("targets needs 1 to 1000 splits with a positive share")
    total = sum(s for _, s in shares)
    sizes = cut(groups.groupBy("group_id").agg(F.count("*").alias("n")))
    rows = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    big = shares[-1][1] / total * rows
    heavy = sizes.where(F.col("n") > big)
    left = {s: w / total * rows for s, w in shares}
    placed = []
    # Fewer than total / smallest share of them, whatever the number of groups.
    for r in sorted(heavy.collect(), key=lambda r: (-r["n"], r["group_id"] is None, r["group_id"])):
        to = max(left, key=lambda s: (left[s], -[x for x, _ in shares].index(s)))
        placed.append((r["group_id"], to))
        left[to] -= r["n"]
    room = [(s, max(0.0, left[s])) for s, _ in shares]
    light = sizes.where(F.col("n") <= big).withColumn("h", F.xxhash64(F.lit(seed), "group_id"))
    # Prefix sums by partition of a range sort: one number per partition reaches the driver.
    laid = cut(light.repartitionByRange("h", "group_id").sortWithinPartitions("h", "group_id").withColumn("p", F.spark_partition_id()))
    sums = dict(laid.groupBy("p").agg(F.sum("n")).collect())
    start, acc = {}, 0
    for p in sorted(sums):
        start[p], acc = acc, acc + sums[p]
    from pyspark.sql import Window

    base = F.element_at(F.create_map(*[F.lit(x) for kv in start.items() for x in kv]), F.col("p")) if start else F.lit(0)
    mid = base + F.sum("n").over(Window.partitionBy("p").orderBy("h", "group_id")) - F.col("n") / 2
    edge, scale, pick = 0.0, (acc / (sum(w for _, w in room) or 1)), F.lit(room[-1][0] if room else None)
    bounds = []
    for s, w in room:
        edge += w * scale
        bounds.append((s, edge))
    for s, e in reversed(bounds[:-1]):
        pick = F.when(mid <= e, F.lit(s)).otherwise(pick)
    chosen = laid.select("group_id", pick.alias("split")).unionByName(groups.sparkSession.createDataFrame(placed, "group_id string, split string"))
    return groups.join(chosen.withColumnRenamed("group_id", "g"), F.col("group_id").eqNullSafe(F.col("g"))).select(id_col, "group_id", "split")
