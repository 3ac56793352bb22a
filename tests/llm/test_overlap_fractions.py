"""Overlap fractions against brute force, and pairs of any length without loss."""

import random

import numpy as np

from tamis.llm import overlap as O

RNG = random.Random(6)
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "tun", "ver", "sol", "pel", "dra") for b in ("ba", "dor", "nis", "te", "gul", "ram")]


def sentence(n: int) -> str:
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def test_an_edit_changes_the_chunks_around_it_only():
    ws = O.words(sentence(200))
    for at in range(0, 200, 7):
        new = list(ws)
        new[at] = 12345
        (_, a, la), (_, b, _) = O.cut_chunks([ws]), O.cut_chunks([new])
        assert len(set(a.tolist()) - set(b.tolist())) <= 3 and la.sum() == 200
    seq, d, n = O.cut_chunks([ws, [], ws[:1], ws])
    assert np.bincount(seq, n).tolist() == [200, 0, 1, 200] and d[seq == 0].tolist() == d[seq == 3].tolist()


def test_fractions_against_brute_force(spark):
    rows, n = [], 0
    base = [(sentence(RNG.randint(0, 30)), sentence(RNG.randint(0, 60))) for _ in range(30)]
    for k in range(300):
        i, r = RNG.choice(base)
        if RNG.random() < 0.6:
            r = r + " " + sentence(RNG.randint(1, 10))
        if RNG.random() < 0.1:
            i = None
        rows.append((k, i, r, RNG.choice(["b1", "b2", None]), RNG.choice(["train", "train", "validation", "test", None]), f"s{k % 4}"))
    got = {x.ord: (x.words, x.shared) for x in O.overlap_fractions(spark.createDataFrame(rows, "ord bigint, instruction string, response string, build string, split string, source_id string")).collect()}
    held: dict = {}
    for _, i, r, b, s, _ in rows:
        if b and s == "train":
            for side, t in enumerate((i, r)):
                held.setdefault(b, set()).update(O.cut_chunks([O.words(t)], side)[1].tolist())
    want = {}
    for o, i, r, b, s, _ in rows:
        if b and s and s != "train":
            total = shared = 0
            for side, t in enumerate((i, r)):
                _, d, ln = O.cut_chunks([O.words(t)], side)
                total += int(ln.sum())
                shared += sum(int(y) for x, y in zip(d.tolist(), ln.tolist()) if x in held.get(b, ()))
            want[o] = (total, shared)
    assert got == want and any(0 < s < t for t, s in want.values())


def test_report(spark):
    text = sentence(40)
    rows = [(1, "explain " + text, "answer " + text, "b", "train", "s"), (2, "explain " + text, "answer " + text, "b", "test", "s"), (3, sentence(20) + " x", "y " + sentence(20), "b", "test", "s"), (4, "explain " + text, "answer " + text, "c", "test", None), (5, None, None, "b", "validation", "s")]
    df = spark.createDataFrame(rows, "ord bigint, instruction string, response string, build string, split string, source_id string")
    got = {(r.build, r.split): (r.rows, r.near_rows, r.mostly_shared) for r in O.overlap_report(df).collect()}
    assert got[("b", "test")] == (2, 1, 1) and got[("c", "test")] == (1, 0, 0) and got[("b", "validation")] == (1, 0, 0)
    assert O.overlap_report(df.limit(0)).count() == 0


def test_both_ways_to_fetch_texts_agree(spark, monkeypatch):
    rows = []
    for k in range(120):
        i, r = sentence(RNG.randint(0, 24)), sentence(RNG.randint(0, 30))
        for o, s in ((2 * k, "train"), (2 * k + 1, "test")):
            ws = r.split()
            if ws and RNG.random() < 0.7:
                ws[RNG.randrange(len(ws))] = "changed"
            rows.append((o, i, " ".join(ws), "b", s, None))
    df = spark.createDataFrame(rows, "ord bigint, instruction string, response string, build string, split string, source_id string")
    one = sorted(tuple(x) for x in O.cross_split(df).collect())
    monkeypatch.setattr(O, "BROADCAST_ROWS", 0)
    assert sorted(tuple(x) for x in O.cross_split(df).collect()) == one


def test_no_near_pair_is_lost_at_any_length(spark):
    """Lengths 0 to 40, edits up to what is near: every pair that the rule accepts comes out, against all pairs."""
    rows = []
    for n in range(41):
        for _ in range(3):
            i, r = sentence(n), sentence(RNG.randint(0, 40))
            k = RNG.randint(0, O.most_edits(n, n))
            ws = i.split()
            for at in RNG.sample(range(n), min(k, n)):
                ws[at] = "changed" + str(RNG.randrange(50))
            rows += [(len(rows), i, r, "b", "train", None), (len(rows) + 1, " ".join(ws), r, "b", "test", None)]
    got = {tuple(x) for x in O.cross_split(spark.createDataFrame(rows, "ord bigint, instruction string, response string, build string, split string, source_id string")).collect()}
    sides = [(O.words(i), O.words(r)) for _, i, r, *_ in rows]
    want = {(min(a, b), max(a, b)) for a in range(0, len(rows), 2) for b in range(1, len(rows), 2) if O.near(sides[a][0], sides[b][0]) and O.near(sides[a][1], sides[b][1])}
    assert got == want and len(want) > 100
