"""Centroid clustering with Yinyang bounds.

Centroids are grouped once. Each vector keeps an upper bound of its distance to
its own centroid and, for each group, a lower bound of the distance to the
group's other centroids. A round first moves the bounds by how far centroids
went. A vector whose upper bound lies below all lower bounds stays (global
filter); of the others only the groups whose bound is not above the upper bound
are scanned, with exact whole distances. Bounds are doubles with a margin, so
whatever they rule out is farther by more than rounding; ties are always scanned.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm._common import Store
from tickloom.llm.vectors import AT_ONCE, blocks, columns_of, moved, squares, totals

DIMS, CENTROIDS, ROUNDS = 64, 40, 5
#: Centroids of a group, about.
GROUP = 10
#: What bounds are widened by: relative and absolute.
MARGIN, LEAST = 1e-9, 1e-6


def seeds(made: DataFrame, n: int, dims: int) -> np.ndarray:
    """The ``n`` vectors whose sha256 of ``2:<vec_id>`` is smallest, in that order; null ids last, of equal ids the smaller vector first."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("data").to_pylist(), strict=True):
                vectors = columns_of(data, dims, len(ids)).T
                rank = [None if i is None else hashlib.sha256(b"2:%d" % i).hexdigest() for i in ids.as_py()]
                some = sorted(range(len(rank)), key=lambda k: (rank[k] is None, rank[k] or ""))  # noqa: B023
                # Ties of the last hash all stay; the sort over all blocks settles them.
                last = rank[some[min(n, len(some)) - 1]]
                some = [*some[:n], *itertools.takewhile(lambda k: rank[k] == last, some[n:])]  # noqa: B023
                yield pa.RecordBatch.from_arrays([pa.array([rank[k] for k in some], pa.string()), pa.array(list(vectors[some]), pa.list_(pa.int32()))], ["rank", "vector"])

    rows = made.select("ids", "data").mapInArrow(least, "rank string, vector array<int>")
    return np.array([r["vector"] for r in rows.orderBy(F.asc_nulls_last("rank"), "vector").limit(n).collect()], np.int64).reshape(-1, dims)


def grouped(centroids: np.ndarray, size: int = GROUP, rounds: int = 5) -> np.ndarray:
    """Each centroid's group: a small clustering of the centroids themselves."""
    n = max(1, len(centroids) // size)
    spots = centroids.astype(np.float64)
    middles = spots[:: max(1, len(spots) // n)][:n]
    for _ in range(rounds):
        group = ((spots[:, None] - middles) ** 2).sum(axis=2).argmin(axis=1)
        middles = np.stack([spots[group == g].mean(axis=0) if (group == g).any() else middles[g] for g in range(n)])
    return np.unique(group, return_inverse=True)[1]


def step(columns: np.ndarray, centroids: np.ndarray, group: np.ndarray, drift: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Move the vectors of a block to their nearest centroids; ``own``, ``upper`` and ``lower`` (vector, group) change in place. The number of distances worked out.

    ``own`` is -1 where a vector has no centroid yet.
    """
    n, groups, worked = len(own), lower.shape[1], 0
    fresh = own < 0
    upper += drift[own] * (1 + MARGIN)
    lower -= np.array([drift[group == g].max() for g in range(groups)]) * (1 + MARGIN)
    upper[fresh], lower[fresh] = np.inf, -np.inf

    def reach(bound: np.ndarray) -> np.ndarray:
        return bound * (1 + MARGIN) + LEAST

    open_ = np.flatnonzero(lower.min(axis=1) <= reach(upper))
    for start in range(0, len(open_), AT_ONCE):
        some = open_[start : start + AT_ONCE]
        vectors = columns[:, some].astype(np.int64)
        at = own[some]
        known = at >= 0
        exact = np.full(len(some), np.iinfo(np.int64).max)
        exact[known] = ((vectors[:, known] - centroids[at[known]].T) ** 2).sum(axis=0)
        worked += int(known.sum())
        tight = np.where(known, np.sqrt(exact.astype(np.float64)), np.inf)
        best, least = at.copy(), exact.copy()
        first = np.full((len(some), groups), np.iinfo(np.int64).max)
        second, who, scanned = first.copy(), np.full((len(some), groups), -1), np.zeros((len(some), groups), bool)
        for g in range(groups):
            rows = np.flatnonzero(lower[some, g] <= reach(tight))
            if not len(rows):
                continue
            members = np.flatnonzero(group == g)
            far = squares(vectors[:, rows], centroids[members])
            worked += far.size
            place = far.argmin(axis=1)
            low = far[np.arange(len(rows)), place]
            far[np.arange(len(rows)), place] = np.iinfo(np.int64).max
            first[rows, g], second[rows, g], who[rows, g], scanned[rows, g] = low, far.min(axis=1), members[place], True
            better = (low < least[rows]) | ((low == least[rows]) & (members[place] < best[rows])) | (best[rows] < 0)
            best[rows[better]], least[rows[better]] = members[place[better]], low[better]
        lowest = np.where(who == best[:, None], second, first)
        lower[some] = np.where(scanned, np.sqrt(lowest.astype(np.float64)) * (1 - MARGIN), lower[some])
        # The centroid that was left is another one of its group now.
        left = np.flatnonzero(known & (best != at))
        out = group[at[left]]
        lower[some[left], out] = np.where(scanned[left, out], lower[some[left], out], np.minimum(lower[some[left], out], tight[left] * (1 - MARGIN)))
        own[some], upper[some] = best, np.sqrt(least.astype(np.float64)) * (1 + MARGIN)
    return worked


STATE = "block long, ids array<long>, data binary, own binary, upper binary, lower binary, sums binary, counts binary, worked long"


def advance(rows: DataFrame, dims: int, centroids: np.ndarray, group: np.ndarray, drift: np.ndarray) -> DataFrame:
    """One assignment of all blocks: their new bounds, and the sums and counts of what each centroid holds."""
    n_groups = int(group.max()) + 1
    # Fixed size: the centroids.
    shared = rows.sparkSession.sparkContext.broadcast((centroids, group, drift))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, group, drift = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                ids, data = batch.column("ids").slice(k, 1), batch.column("data")[k].as_py()
                n = len(ids[0])
                own, upper, lower = (np.frombuffer(batch.column(c)[k].as_py() or b"", t).copy() for c, t in (("own", np.int32), ("upper", np.float64), ("lower", np.float32)))
                if not len(own):
                    own, upper, lower = np.full(n, -1, np.int32), np.zeros(n), np.zeros(n * n_groups, np.float32)
                columns, bounds = columns_of(data, dims, n), lower.reshape(n, n_groups).astype(np.float64)
                worked = step(columns, centroids, group, drift, own, upper, bounds)
                sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
                np.add.at(sums, own, columns.T)
                np.add.at(counts, own, 1)
                # Single precision, rounded down.
                short = np.nextafter(bounds.astype(np.float32), np.float32(-np.inf))
                values = [x.tobytes() for x in (own, upper, short, sums, counts)]
                arrays = [batch.column("block").slice(k, 1), ids, pa.array([data], pa.binary()), *(pa.array([v], pa.binary()) for v in values), pa.array([worked], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in STATE.split(", ")])

    return rows.mapInArrow(move, STATE)


def cluster(vectors: DataFrame, vector: str = "embedding", n: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS) -> tuple[DataFrame | None, np.ndarray, list[int]]:
    """(blocks with their last assignment, final centroids, distances worked out in each assignment)."""
    store = Store(vectors.sparkSession)
    made = blocks(vectors, store, vector, dims=dims)
    centroids = seeds(made, n, dims)
    if not len(centroids):
        return None, centroids, []
    group, drift, worked = grouped(centroids), np.zeros(len(centroids)), []
    rows = made.select("block", "ids", "data", *(F.lit(None).cast("binary").alias(c) for c in ("own", "upper", "lower")))
    old = made
    for r in range(rounds + 1):
        kept = store.keep(advance(rows, dims, centroids, group, drift))
        store.drop(old)
        old, shape = kept, centroids.shape

        def measure(row):
            return np.frombuffer(bytes(row[0]), np.int64).reshape(shape), np.frombuffer(bytes(row[1]), np.int64), np.array([row[2]])  # noqa: B023

        sums, counts, work = totals(kept.select("sums", "counts", "worked").rdd, measure)
        worked.append(int(work[0]))
        rows = kept.drop("sums", "counts", "worked")
        if r < rounds:
            before, centroids = centroids, moved(centroids, sums, counts)
            drift = np.sqrt(((centroids - before) ** 2).sum(axis=1).astype(np.float64))
    return rows, centroids, worked


RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clusters(vectors: DataFrame, vector: str = "embedding", n: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each row whose vector has ``dims`` usable components.

    Dropped: null vectors, other lengths, null or non-finite components.
    Components beyond 524288 saturate. Null ids stay, and seed a cluster only
    when others are too few; repeated rows repeat. With fewer vectors than
    centroids each is a centroid. Sums beyond 64 bits are null. An empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    rows, centroids, _ = cluster(vectors, vector, n, rounds, dims)
    if rows is None:
        return spark.createDataFrame([], RESULT)
    shared = spark.sparkContext.broadcast(centroids)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, own in zip(batch.column("ids"), batch.column("data").to_pylist(), batch.column("own").to_pylist(), strict=True):
                at = np.frombuffer(own, np.int32)
                far = ((columns_of(data, dims, len(at)).T.astype(np.int64) - shared.value[at]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(at), pa.array(far)], ["vec_id", "cluster", "distance"])

    told = rows.select("ids", "data", "own").mapInArrow(tell, "vec_id long, cluster int, distance long")
    # One row a cluster, so the sums may pass through the driver.
    sums = {r["cluster"]: r["s"] for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}

    def long(value) -> int | None:
        return int(value) if value < 1 << 63 else None

    inertia = long(sum(sums.values()))
    about = [(c, long(s), inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in sums.items()]
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return told.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(n: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The same in DuckDB, every distance worked out."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"d{r} AS (SELECT vec_id, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM parts v JOIN c{r} c USING (i) GROUP BY vec_id, c.k)")
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, min(d * {n} + k) AS m FROM d{r} GROUP BY vec_id)")
        if r < rounds:
            mean = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
            steps.append(f"m{r} AS (SELECT a.m % {n} AS k, i, {mean} AS x FROM a{r} a JOIN parts USING (vec_id) GROUP BY a.m % {n}, i)")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k AND c.i = m.i)")
    return f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (SELECT vec_id, CAST(t.i AS BIGINT) AS i, v[t.i] AS x FROM kept, range(1, {DIMS + 1}) t(i)
), seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k FROM kept WHERE vec_id IS NOT NULL ORDER BY k LIMIT {n}
), c0 AS MATERIALIZED (SELECT k, i, x FROM parts JOIN seeds USING (vec_id)
), {", ".join(steps)},
told AS (SELECT vec_id, CAST(m % {n} AS INTEGER) AS cluster, CAST(m // {n} AS BIGINT) AS distance FROM a{rounds}),
sums AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM told GROUP BY cluster),
digest AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, cluster, distance, cluster_inertia, CAST((SELECT sum(cluster_inertia) FROM sums) AS BIGINT) AS inertia, centroid_sha256
FROM told JOIN sums USING (cluster) JOIN digest ON digest.k = told.cluster
"""


ORACLE_SQL = _sql()
