"""Centroid clustering against brute force and against SQL."""

import hashlib

import duckdb
import numpy as np
import pytest

from stratavox.llm import centroids

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, v int, distance double"


def brute(rows, width, k, rounds):
    """(vec_id, cluster, distance, its cluster's sum, all, hash), sorted; each vector is compared with every centroid."""
    kept = [(i, np.floor(64 * np.array(e, np.float64)).astype(object).tolist()) for i, e in rows if e is not None and len(e) == width and all(x is not None and np.isfinite(x) for x in e)]
    kept = [(i, [int(x) for x in v]) for i, v in kept]
    if not kept:
        return []
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centres = [v for _, v in first[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        now = assigned()
        for j in range(len(centres)):
            own = [v for (_, v), (_, who) in zip(kept, now, strict=True) if who == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    now = assigned()
    total = {j: sum(d for d, who in now if who == j) for j in range(len(centres))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((repr(i), who, d, total[who], sum(total.values()), names[who]) for (i, _), (d, who) in zip(kept, now, strict=True))


def table(spark, rows):
    return spark.createDataFrame([(i, e, 1, "c", 2, 0.5) for i, e in rows], SCHEMA)


def found(df):
    return sorted((repr(r[0]), *r[1:]) for r in df.collect())


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-3, 4, 4) / 64).tolist()) for i in range(150)]  # few values, so many ties and equal vectors
    rows += [(None, [0.5, 0.25, -1.0, 3.0]), (None, [0.0] * 4), (200, None), (201, []), (202, [1.0] * 3), (203, [1.0, None, 0.0, 0.0]), (204, [float("nan")] * 4), (205, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [rows[0], rows[0], (7, [9.0, 9.0, 9.0, 9.0])]
    for k, rounds in ((1, 2), (5, 0), (5, 3), (300, 2)):
        assert found(centroids.cluster(table(spark, rows), 4, k, rounds)) == brute(rows, 4, k, rounds)


def test_empty_and_unfit(spark):
    assert centroids.cluster(table(spark, [])).collect() == []
    assert centroids.cluster(table(spark, [(1, None), (2, [1.0])])).collect() == []
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(table(spark, [(1, [1e30] * 4)]), 4).collect()


def test_looks_at_few_centroids(monkeypatch):
    """In separate clouds a vector that is near its centroid looks at no other."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-1000, 1000, (16, 8))
    v = np.repeat(centres, 50, axis=0) + rng.integers(-3, 4, (800, 8))
    before = np.repeat(np.arange(16), 50)
    seen = []
    real = centroids.squares
    monkeypatch.setattr(centroids, "squares", lambda x, c: seen.append(len(x)) or real(x, c))
    label, least = centroids.nearest(v, before, centres)
    assert (label == before).all() and (least == ((v - centres[before]) ** 2).sum(axis=1)).all()
    assert sum(seen) <= 16 * 16 + 800


def test_same_from_any_start():
    rng = np.random.default_rng(1)
    centres, v = rng.integers(-4, 5, (9, 3)), rng.integers(-4, 5, (500, 3))
    every = ((v[:, None, :] - centres[None]) ** 2).sum(axis=2)
    for a in range(9):
        label, least = centroids.nearest(v, np.full(500, a), centres)
        assert (least == every.min(axis=1)).all() and (label == every.argmin(axis=1)).all()


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert sorted(con.execute(centroids.OP12_SQL).fetchall()) == sorted(map(tuple, centroids.op12_centroids(spark, SF).collect()))
