"""Centroid clustering by sort-means: exact integer rounds in which each vector looks at few centroids only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavox.llm.common import batch_of, buffer, configure, drop, materialise, table

#: Components of a vector, steps in one unit of a component, centroids, rounds, and what the hash of the first centroids starts with.
WIDTH, SCALE, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, "1:"
#: Scaled components lie within this of 0, so that squared distances fit 64 bits.
MOST = 1 << 27
VECTORS = "vec_id long, v binary"
ASSIGNED = "vec_id long, v binary, cluster int, distance long"
SUMS = "cluster int, axis int, total long, n long"


def scaled(width: int, scale: int):
    """For mapInArrow over (vec_id, embedding): the vectors that count, as int32 components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).cast(pa.large_list(pa.float64()))
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False)  # a null becomes NaN
            own = np.flatnonzero((np.diff(offsets) == width) & lists.is_valid().to_numpy(zero_copy_only=False))
            x = values[offsets[own][:, None] + np.arange(width)] if len(own) else np.zeros((0, width))
            finite = np.isfinite(x).all(axis=1)
            x = np.floor(scale * x[finite])
            if x.size and np.abs(x).max() > MOST:
                raise ValueError(f"a scaled component is beyond {MOST}, so squared distances may not fit 64 bits")
            rows = x.astype("<i4")
            yield batch_of(VECTORS, batch.column(0).take(pa.array(own[finite])), [r.tobytes() for r in rows])

    return run


def squares(v: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of rows to one centroid."""
    apart = v.astype(np.int64) - centre
    return np.einsum("ij,ij->i", apart, apart)


def nearest(v: np.ndarray, before: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: the smaller number) and the squared distance.

    A row of centroid a looks at the others in the order of their distance from a. One that is strictly beyond twice the
    row's own distance to a is farther from the row than a is, and so are all after it.
    """
    gaps = np.stack([squares(centres, c) for c in centres])
    label, least = before.astype(np.int64), np.zeros(len(v), np.int64)
    for a in np.unique(before):
        rows = np.flatnonzero(before == a)
        own = squares(v[rows], centres[a])
        order = np.argsort(-own, kind="stable")  # those that look farthest come first
        rows, own = rows[order], own[order]
        best, who = own.copy(), np.full(len(rows), a)
        for j in np.argsort(gaps[a], kind="stable"):
            looking = int(np.searchsorted(-4 * own, -gaps[a, j], "right"))
            if not looking:
                break
            if j == a:
                continue
            there = squares(v[rows[:looking]], centres[j])
            better = np.flatnonzero((there < best[:looking]) | ((there == best[:looking]) & (j < who[:looking])))
            best[better], who[better] = there[better], j
        label[rows], least[rows] = who, best
    return label, least


def assign(centres: np.ndarray, width: int):
    """For mapInArrow over (vec_id, v, cluster): ASSIGNED rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.frombuffer(buffer(batch.column(1))[0].tobytes(), "<i4").reshape(-1, width)
            label, least = nearest(v, batch.column(2).to_numpy(), centres)
            yield batch_of(ASSIGNED, batch.column(0), batch.column(1), label.astype(np.int32), least)

    return run


def partial_sums(width: int, centroids: int):
    """For mapInArrow over (v, cluster): a task's sums by cluster and component, once at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((centroids, width), np.int64), np.zeros(centroids, np.int64)
        for batch in batches:
            v = np.frombuffer(buffer(batch.column(0))[0].tobytes(), "<i4").reshape(-1, width).astype(np.int64)
            cluster = batch.column(1).to_numpy()
            n += np.bincount(cluster, minlength=centroids)
            for k in np.unique(cluster):
                total[k] += v[cluster == k].sum(axis=0)
        used = np.flatnonzero(n)
        yield batch_of(SUMS, np.repeat(used, width), np.tile(np.arange(width), len(used)), total[used].ravel(), np.repeat(n[used], width))

    return run


def moved(found: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The floor of each cluster's mean; a centroid without vectors stays. The driver gets a number for each component of a centroid."""
    centroids, width = centres.shape
    sums = found.select("v", "cluster").mapInArrow(partial_sums(width, centroids), SUMS)
    exact = sums.groupBy("cluster", "axis").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = centres.copy()
    for r in exact.collect():
        out[r.cluster, r.axis] = int(r.total) // r.n
    return out


def cluster(vectors: DataFrame, width: int = WIDTH, centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector of `width` finite components.

    Components are floor(scale * x). The first centroids are the vectors with the least sha256 of "1:<vec_id>", so there are
    fewer where fewer vectors are kept. Vectors that are null, of another width, or hold a null, NaN or infinity give no row;
    an empty table gives none. Repeated rows are kept, and each counts; of rows with one vec_id those of smaller components
    (as bytes) come first as centroids. A null vec_id is hashed as an empty one. Other columns are ignored.
    Each round writes the vectors with their cluster, from which the next one looks on; sums go by task, then by cluster.
    """
    found = vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(scaled(width, scale), VECTORS)
    found = materialise(found.withColumn("cluster", F.lit(0)).withColumn("distance", F.lit(0).cast("long")), "vectors")
    rank = F.sha2(F.concat(F.lit(SEED), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    seeds = found.select(rank.alias("rank"), "v").orderBy("rank", "v").limit(centroids).collect()
    if not seeds:
        return found.select("vec_id", "cluster", "distance", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    centres = np.stack([np.frombuffer(r.v, "<i4") for r in seeds]).astype(np.int64)
    for k in range(rounds + 1):
        after = materialise(found.select("vec_id", "v", "cluster").mapInArrow(assign(centres, width), ASSIGNED), "vectors")
        drop(found)
        found = after
        if k < rounds:
            centres = moved(found, centres)
    inertia = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    every = sum(inertia.values())
    facts = [(k, n, every, hashlib.sha256(",".join(map(str, centres[k].tolist())).encode()).hexdigest()) for k, n in inertia.items()]
    known = found.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.select("vec_id", "cluster", "distance").join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    """All vectors of `embeddings` in 16 clusters after three rounds."""
    configure(spark)
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    apart = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT)))"
    parts = [
        f"kept AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}' || vec_id)) - 1 AS k, v FROM kept ORDER BY sha256('{SEED}' || vec_id) LIMIT {CENTROIDS})",
    ]
    for i in range(ROUNDS + 1):
        parts.append(f"d{i} AS (SELECT p.r, c.k, {apart} AS d FROM kept p, c{i} c)")
        parts.append(f"a{i} AS (SELECT r, k, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, k) AS place FROM d{i}) WHERE place = 1)")
        if i < ROUNDS:
            parts.append(f"s{i} AS (SELECT k, i, sum(CAST(v[i] AS HUGEINT)) AS s, CAST(count(*) AS HUGEINT) AS n FROM kept JOIN a{i} USING (r), range(1, {WIDTH + 1}) t(i) GROUP BY k, i)")
            parts.append(f"m{i} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{i} GROUP BY k)")
            parts.append(f"c{i + 1} AS (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k))")
    last = f"SELECT p.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM kept p JOIN a{ROUNDS} a USING (r) JOIN c{ROUNDS} c USING (k)"
    return f"WITH {', '.join(parts)} {last}"


OP12_SQL = _sql()
