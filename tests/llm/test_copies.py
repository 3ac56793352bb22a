"""Copies across repositories against brute force, and many equal copies in proportion."""

import random
from datetime import datetime, timedelta

import pytest

from tamis.llm import handwritten as H

SCHEMA = "ord bigint, repo string, at timestamp_ntz, found boolean, third string, lines array<bigint>"
DAY = datetime(2024, 1, 1)


def brute(files):
    """The definition, file by file."""
    out = set()
    groups: dict = {}
    for f in files:
        groups.setdefault(frozenset(f[5]), []).append(f)

    def two(fs):
        first = {}
        for f in sorted(fs, key=lambda f: (f[2], f[0])):
            first.setdefault(f[1], f)
        return list(first.values())[:2]

    for o, repo, at, found, _, lines in files:
        if found or repo is None or not lines:
            continue
        near = [g for s, g in groups.items() if len(s & set(lines)) >= 0.8 * len(set(lines)) and s]
        near = [[f for f in g if f[1] is not None] for g in near]
        heads = [f for g in near for f in g if f[1] != repo and (f[2], f[0]) < (at, o)]
        # The earliest third-party copies of two repositories, of each content that holds the file.
        foreign = [f for g in near for f in two([f for f in g if f[4] is not None]) if f[1] != repo and repo.replace("/", "_") not in f[4]]
        if heads or foreign:
            out.add(o)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    bases = [[rng.getrandbits(50) for _ in range(rng.randint(8, 40))] for _ in range(12)]
    common = [rng.getrandbits(50) for _ in range(5)]
    files = []
    for o in range(220):
        base = rng.choice(bases)
        lines = set(base[: rng.randint(max(8, len(base) * 2 // 3), len(base))]) | set(rng.sample(common, rng.randint(0, 3)))
        if rng.random() < 0.5:
            lines |= {rng.getrandbits(50) for _ in range(rng.randint(0, 4))}
        repo = rng.choice([None, *(f"o{k}/r" for k in range(7))])
        third = rng.choice([None, None, None, "vendor_o1_r_x.go", "third_party_lib.go"])
        files.append((o, repo, DAY + timedelta(days=rng.randint(0, 30)), third is not None or rng.random() < 0.1, third, list(lines)))
    got = {r.ord for r in H.foreign_copies(spark.createDataFrame(files, SCHEMA)).collect()}
    assert got == brute(files)


def test_one_file_in_many_repositories(spark):
    """20,000 repositories with the same file: rows in proportion, all but the earliest are copies."""
    n = 20_000
    df = spark.range(n).selectExpr("id as ord", "concat('o', id, '/r') as repo", "timestamp_ntz'2024-01-01 00:00:00' as at", "false as found", "cast(null as string) as third", "transform(sequence(1, 30), x -> cast(x * 7919 as bigint)) as lines")
    got = H.foreign_copies(df)
    assert got.count() == n - 1 and got.where("ord = 0").count() == 0


def test_an_edited_vendored_copy_without_banner(spark):
    lines = [f"result = compute_the_value_of({i}, limit)" for i in range(30)]
    mine = "\n".join(lines)
    edited = "\n".join(x if i % 10 else x.replace("limit", "other_limit") for i, x in enumerate(lines))
    rows = [(1, "a/lib", "src/compute.py", mine, "2024-01-01 00:00:00"), (2, "b/app", "util/compute.py", edited, "2024-02-01 00:00:00"), (3, "b/app", "util/own.py", "\n".join(f"own line number {i} of the file" for i in range(30)), "2024-02-01 00:00:00")]
    docs = spark.createDataFrame(rows, "ord bigint, repo string, file_path string, content string, read_at string")
    down = spark.createDataFrame([(1, "lex.calc.c"), (2, "src/lexer.c"), (3, "gen/y.tab.h"), (4, None)], "ord bigint, local_path string")
    got = sorted(tuple(r) for r in H.not_handwritten(docs, down).collect())
    assert got == [("documents_raw", 2), ("download_results", 1), ("download_results", 3)]


def test_banners_in_other_words():
    for line in ("// Imported verbatim from someone/library release 1.2.3. Local changes are not allowed.", "# Synced from upstream, unmodified", "/* Taken unchanged from https://host.example/lib */", "// Copied from zlib v1.2 with fixes"):
        assert H.banner(line + "\npackage x\n", H.THIRD_BANNER), line
    for line in ("// values imported from the settings page", "// see the licensing page before you vendor the cache", "// the vendored copy was removed, this is our own version", "// copied from the request, not generated"):
        assert not H.banner(line + "\npackage x\n"), line
