"""Clusters against a plain search and the SQL twin."""

import hashlib
import math
import random

import numpy as np
import pytest
from check_oracles import canonical, connect

from vialume.llm import centroids as op

GIVEN = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, cluster string, ids long, distance int"


def plain(rows, k=16, rounds=3, dim=64):
    """(vec_id, cluster, distance, own inertia, inertia, centroid digest) of every proper row."""
    kept = [(i, [math.floor(64 * x) if abs(x) < 1e300 else int(x) * 64 for x in v]) for i, v in rows
            if v is not None and len(v) == dim and None not in v and all(map(math.isfinite, v))]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    cs = [x for _, x in start]
    if not cs:
        return []

    def near(x):
        d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in cs]
        return min(range(len(cs)), key=lambda c: (d[c], c)), min(d)

    for _ in range(rounds):
        by = [[] for _ in cs]
        for _, x in kept:
            by[near(x)[0]].append(x)
        cs = [[sum(col) // len(own) for col in zip(*own)] if own else c for c, own in zip(cs, by)]
    found = [(i, *near(x)) for i, x in kept]
    own = {c: sum(d for _, b, d in found if b == c) for c in range(len(cs))}
    fits = lambda x: x if x < 2**63 else None
    return sorted([(i, c, fits(d), fits(own[c]), fits(sum(own.values())), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest())
                   for i, c, d in found], key=repr)


def saved(spark, folder, rows):
    spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/embeddings.parquet")


def vectors(seed, n, spread, grid=None):
    pick = random.Random(seed)
    heart = [[pick.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    rows = [(i, [x + pick.gauss(0, spread) for x in pick.choice(heart)]) for i in range(n)]
    if grid:  # many equal distances
        rows = [(i, [round(x * grid) / 64 for x in v]) for i, v in rows]
    same = rows[0][1]
    rows += [(10_000 + i, same) for i in range(n // 3)]
    rows += [(20_000, None), (20_001, []), (20_002, [1.0] * 63), (20_003, [None] + [1.0] * 63), (20_004, [float("nan")] * 64),
             (20_005, [float("inf")] + [0.0] * 63), (20_006, [0.0] * 64), (None, [0.5] * 64), (None, None), rows[1], rows[1]]
    return rows


@pytest.mark.parametrize(("seed", "n", "spread", "grid"), [(1, 400, 0.2, None), (2, 300, 1.5, None), (3, 300, 0.5, 1), (4, 9, 1.0, None)])
def test_against_a_plain_search(spark, tmp_path, rows, monkeypatch, seed, n, spread, grid):
    monkeypatch.setattr(op, "BLOCK", 37)
    given = vectors(seed, n, spread, grid)
    saved(spark, tmp_path, given)
    assert rows(op.run(spark, str(tmp_path))) == plain(given)


@pytest.mark.parametrize("size", [1e6, 1e9, 1e30, 1e200])
def test_large_components_are_exact(spark, tmp_path, rows, size):
    pick = random.Random(5)
    given = [(i, [pick.choice([-1, 1]) * size * pick.random() for _ in range(64)]) for i in range(40)]
    saved(spark, tmp_path, given)
    assert rows(op.run(spark, str(tmp_path))) == plain(given)


@pytest.mark.parametrize("given", [[], [(None, [1.0] * 64)], [(1, None)]])
def test_no_starts(spark, tmp_path, given):
    saved(spark, tmp_path, given)
    assert op.run(spark, str(tmp_path)).count() == 0


def test_only_used_up_gaps_are_popped():
    heaps = op.Heaps.of(np.array([0, 0, 1, 1]), np.array([0.5, 3.0, 1.0, 0.0]), [0.0, 2.0])
    heaps = op.Heaps.unpack(*heaps.pack())
    assert heaps.cluster_of(4).tolist() == [0, 0, 1, 1]
    assert heaps.expired([1.0, 2.5]) == ([0, 1], [0, 3])
    heaps.push(np.array([1, 0]), [0, 3], np.array([0.1, 9.0]), [1.0, 2.5])
    assert heaps.cluster_of(4).tolist() == [1, 0, 1, 0]
    assert heaps.expired([3.0, 3.0]) == ([0, 1, 1], [1, 0, 2])


def test_few_vectors_are_scanned_again():
    """Of well separated groups nearly all vectors keep their gap when the centroids settle."""
    rng = np.random.default_rng(1)
    hearts = rng.normal(0, 50, (8, 64)).round()
    x = np.floor(hearts.repeat(100, axis=0) + rng.normal(0, 2, (800, 64)))
    first = [list(map(int, h)) for h in hearts]
    cluster, gaps = op.scan(x, first)
    after = [[int(v) for v in np.floor(x[cluster == c].mean(axis=0))] for c in range(8)]
    heaps = op.Heaps.of(cluster, gaps, [0.0] * 8)
    assert len(heaps.expired(op.moved(first, after))[1]) < 8


@pytest.mark.parametrize("where", ["made", "given"])
def test_sql_twin(spark, tmp_path, where):
    con, folder = connect(GIVEN), GIVEN
    if where == "made":
        saved(spark, tmp_path, [r for r in vectors(7, 200, 0.6) if r[0] not in (None, 1)])
        folder = str(tmp_path)
        con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    found = op.run(spark, folder)
    twin = con.execute(op.SQL)
    names = [d[0] for d in twin.description]
    assert canonical(found.columns, [tuple(r) for r in found.collect()]) == canonical(names, twin.fetchall())
