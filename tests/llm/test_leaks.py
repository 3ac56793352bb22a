"""Passages of items: shared ones, random edits, ids of any type, several passes."""

import random

import numpy as np

from tamis.llm import leaks

RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("bcdfglmnprstv") + RNG.choice("aeiou") for _ in range(RNG.randint(1, 4))) for _ in range(4000)]


def text(n: int, rng: random.Random = RNG) -> list[str]:
    return [rng.choice(VOCABULARY) for _ in range(n)]


def edited(ws: list[str], k: int, rng: random.Random) -> list[str]:
    """``k`` words changed, dropped or added inside."""
    out = list(ws)
    for at in sorted(rng.sample(range(1, len(ws) - 1), k), reverse=True):
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = "changed" + str(rng.randrange(99))
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, "added" + str(rng.randrange(99)))
    return out


def test_random_edits_up_to_one_in_six(spark):
    rng = random.Random(8)
    items = [(i, text(rng.randint(40, 120), rng)) for i in range(60)]
    docs, want = [], set()
    for d in range(600):
        i, ws = rng.choice(items)
        n = rng.randint(20, min(60, len(ws)))
        at = rng.randrange(len(ws) - n + 1)
        k = rng.randint(0, n // 6)
        docs.append((d, " ".join(text(rng.randint(0, 200), rng) + edited(ws[at : at + n], k, rng) + text(rng.randint(0, 200), rng))))
        want.add((d, i))
    docs += [(1000 + d, " ".join(text(80, rng) + rng.choice(items)[1][5:12] + text(80, rng))) for d in range(100)]
    got = {tuple(r) for r in leaks.leaked(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")).collect()}
    # edits at the borders can leave under 20 words of the passage
    assert len(got & want) >= 0.97 * len(want) and all(d < 1000 for d, _ in got)


def test_a_passage_that_many_items_share(spark):
    stem = text(24)
    items = [(f"q-{i}", " ".join(text(20) + stem + text(20))) for i in range(12)]
    ws = list(stem[:20])
    for at in (4, 10, 16):
        ws[at] = "other" + str(at)
    docs = [("a", " ".join(text(50) + ws + text(50)), 1), ("b", " ".join(text(50) + stem + text(30)), 2), ("c", None, 3), ("d", "", 4), ("b", " ".join(stem), 5)]
    df = spark.createDataFrame(docs, "doc_id string, text string, item_id int")
    got = sorted(tuple(r) for r in leaks.leaked(df, spark.createDataFrame(items + items[:1], "item_id string, text string")).collect())
    assert got == sorted((d, f"q-{i}") for d in ("a", "b", "b") for i in range(12))


def test_passes_and_empty_tables(spark):
    items = [(i, " ".join(text(30))) for i in range(9)]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(items)], "doc_id bigint, text string")
    df = spark.createDataFrame(items, "item_id int, text string")
    one, many = (sorted(tuple(r) for r in leaks.leaked(docs, df, per_pass=n).collect()) for n in (10**6, 70))
    assert one == many == [(i, i) for i in range(9)]
    assert leaks.leaked(docs, df.limit(0)).count() == leaks.leaked(docs.limit(0), df).count() == 0


def test_filters_miss_no_passage():
    rng = random.Random(3)
    for _ in range(300):
        ws = text(40, rng)
        n = rng.randint(20, 40)
        part = edited(ws[:n], rng.randint(0, n // 6), rng)
        known: dict[str, int] = {}
        a, b = leaks.word_hashes(ws, known), leaks.word_hashes(text(9, rng) + part + text(9, rng), known)
        if leaks.passage(a, b):
            assert leaks.may_share(np.isin(a, b)[None, :])[0] and leaks.may_align(a, b) and leaks.may_hold(a, b)
            assert leaks.may_share(np.isin(leaks.pair_buckets(a), leaks.pair_buckets(b))[None, :], 2)[0]
