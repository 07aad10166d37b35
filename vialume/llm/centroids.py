"""Clusters around centroids with heap-ordered bounds, exact in whole numbers.

Method. For each vector the distance to its own centroid (upper) and to the second nearest (lower) are known after one full
scan. Each cluster of a block of vectors keeps a heap of the gaps, lower minus upper. When centroids move, a gap can shrink by
at most the movement of the own centroid plus the largest movement of another, so the sum of these (drift) is kept for each
cluster, and a gap enters the heap offset by the drift at that time. Only vectors whose entry is at most the drift of
their cluster are popped, compared with all centroids exactly and pushed on the heap of the cluster they are in now; all others
surely stay. Sums of clusters change by the vectors that moved only.

Spread over executors. Vectors are cut into blocks of ``BLOCK`` rows with their heaps; a round reads every block, pops, and writes
the blocks for the next round to the shared folder, where the blocks of the round before are no longer needed. There is no
shuffle of vectors and no key, so equal vectors spread as they lie. A round brings one sum for each cluster and dimension to the
driver, added up on the executors.

Arithmetic. A component x is the whole number floor(scale * x). Up to ``EXACT`` in size, squared distances are exact
in 64 bits; blocks with larger components use Python's whole numbers. Sums are decimal, centroids whole numbers
of any size. Bounds are floating-point numbers, kept on the safe side by ``SLACK``; ties are never skipped, so
they go to the smaller number.

Defined results: vectors that are null, hold null or non-finite components or have another number of components take
no part (components of 2**1000 and more in size count as not finite). Repeated rows are vectors of their own. Rows with a null id are assigned, but do not start a centroid. With fewer
vectors than centroids every one starts a centroid (none, if all ids are null: then all centroids are empty and there are no
rows). Starts of equal hash are ordered by their components. Distances and inertias that do not fit a long are null.
Columns other than the id and the vector are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import Round, table

QUERY = "op11_centroid_clustering"
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
DIM = 64
BLOCK = 1024
EXACT = 1 << 26
SLACK = 1e-9
MOST = 2.0**1000
LIMB = 96
_STATE = "ids array<long>, vectors binary, keys binary, members binary, ends binary"


def whole_vectors(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Proper vectors as rows of whole numbers (as doubles), and their row numbers."""
    lengths = np.array([-1 if n is None else n for n in pc.list_value_length(column).to_pylist()], dtype=np.int64)
    rows = np.flatnonzero(lengths == dim)
    flat = pc.list_flatten(column.take(pa.array(rows)))
    if flat.null_count:
        flat = pc.fill_null(flat.cast(pa.float64()), float("nan"))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        proper = (np.abs(values) < MOST).all(axis=1)  # false for what is not a number
        return np.floor(values[proper] * scale), rows[proper]


def _plain(vectors: np.ndarray, centroids: list[list[int]]) -> bool:
    """Whether 64 bits hold all squared distances."""
    most = max([np.abs(vectors).max(initial=0), *[abs(x) for c in centroids for x in c]])
    return most <= EXACT and vectors.shape[1] <= 256


def squared_distances(vectors: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Exact squared distances, vectors by centroids."""
    if _plain(vectors, centroids):
        x = vectors.astype(np.int64)
        return np.stack([((x - np.array(c, np.int64)) ** 2).sum(axis=1) for c in centroids], axis=1)
    x = np.array([[int(v) for v in row] for row in vectors], dtype=object).reshape(vectors.shape)
    return np.stack([((x - np.array(c, object)) ** 2).sum(axis=1) for c in centroids], axis=1)


def scan(vectors: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector (ties: the smaller number) and a lower bound on the gap to the second nearest.

    Vectors with very large components get a gap below 0, which is used up at once.
    """
    squared = squared_distances(vectors, centroids)
    if squared.dtype == object:
        return np.array([min(range(len(r)), key=r.__getitem__) for r in squared], np.int64), np.full(len(vectors), -1.0)
    cluster = squared.argmin(axis=1)
    if len(centroids) == 1:
        return cluster, np.full(len(vectors), np.inf)
    root = np.sqrt(squared.astype(np.float64))
    own = root[np.arange(len(root)), cluster]
    root[np.arange(len(root)), cluster] = np.inf
    second = root.min(axis=1)
    return cluster, (second - own) - SLACK * (second + own) - 1e-300


class Heaps:
    """For each cluster a heap of (gap offset by the drift, row of the block)."""

    def __init__(self, heaps: list[list[tuple[float, int]]]) -> None:
        self.heaps = heaps

    @classmethod
    def of(cls, cluster: np.ndarray, gaps: np.ndarray, drift: list[float]) -> Heaps:
        heaps: list[list[tuple[float, int]]] = [[] for _ in drift]
        for row, (c, gap) in enumerate(zip(cluster.tolist(), gaps.tolist(), strict=True)):
            heaps[c].append((gap + drift[c], row))
        for heap in heaps:
            heapq.heapify(heap)
        return cls(heaps)

    def expired(self, drift: list[float]) -> tuple[list[int], list[int]]:
        """Pop the rows whose gap is used up; their clusters and rows."""
        clusters, rows = [], []
        for c, heap in enumerate(self.heaps):
            while heap and heap[0][0] <= drift[c] * (1 + SLACK):
                clusters.append(c)
                rows.append(heapq.heappop(heap)[1])
        return clusters, rows

    def push(self, cluster: np.ndarray, rows: list[int], gaps: np.ndarray, drift: list[float]) -> None:
        for c, row, gap in zip(cluster.tolist(), rows, gaps.tolist(), strict=True):
            heapq.heappush(self.heaps[c], (gap + drift[c], row))

    def pack(self) -> tuple[bytes, bytes, bytes]:
        keys = np.array([k for heap in self.heaps for k, _ in heap], np.float64)
        rows = np.array([r for heap in self.heaps for _, r in heap], np.int32)
        return keys.tobytes(), rows.tobytes(), np.cumsum([len(heap) for heap in self.heaps]).astype(np.int32).tobytes()

    @classmethod
    def unpack(cls, keys: bytes, rows: bytes, ends: bytes) -> Heaps:
        items = list(zip(np.frombuffer(keys, np.float64).tolist(), np.frombuffer(rows, np.int32).tolist(), strict=True))
        stops = np.frombuffer(ends, np.int32).tolist()
        return cls([items[a:b] for a, b in zip([0, *stops], stops, strict=False)])

    def cluster_of(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for c, heap in enumerate(self.heaps):
            out[[row for _, row in heap]] = c
        return out


def _packed(vectors: np.ndarray) -> bytes:
    """A letter for the kind of number, then the numbers."""
    most = np.abs(vectors).max(initial=0)
    kind = b"h" if most < 1 << 15 else b"i" if most < 1 << 31 else b"d"
    return kind + vectors.astype(kind.decode()).tobytes()


def _unpacked(value: pa.BinaryScalar, dim: int) -> np.ndarray:
    raw = value.as_buffer().to_pybytes()
    return np.frombuffer(raw, raw[:1].decode(), offset=1).astype(np.float64).reshape(-1, dim)


def _block(ids: list, vectors: np.ndarray, heaps: Heaps) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([_packed(vectors)], pa.binary()),
                                       *[pa.array([x], pa.binary()) for x in heaps.pack()]], names=["ids", "vectors", "keys", "members", "ends"])


def first_blocks(rows: DataFrame, centroids: list[list[int]], dim: int, scale: int) -> DataFrame:
    """Blocks of vectors after one full scan."""
    still = [0.0] * len(centroids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, at = whole_vectors(batch.column(1), dim, scale)
            ids = batch.column(0).take(pa.array(at)).to_pylist()
            for i in range(0, len(ids), BLOCK):
                part = vectors[i:i + BLOCK]
                yield _block(ids[i:i + BLOCK], part, Heaps.of(*scan(part, centroids), still))

    return rows.mapInArrow(read, _STATE)


def next_blocks(blocks: DataFrame, centroids: list[list[int]], drift: list[float], dim: int) -> DataFrame:
    """Blocks after the centroids have moved: only rows with a used-up gap are scanned."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors, *heap in zip(*batch.columns, strict=True):
                vectors = _unpacked(vectors, dim)
                heaps = Heaps.unpack(*[x.as_py() for x in heap])
                _, rows = heaps.expired(drift)
                if rows:
                    cluster, gaps = scan(vectors[rows], centroids)
                    heaps.push(cluster, rows, gaps, drift)
                yield _block(ids.as_py(), vectors, heaps)

    return blocks.mapInArrow(read, _STATE)


def cluster_sums(blocks: DataFrame, k: int, dim: int) -> tuple[list[int], list[list[int]]]:
    """Number of vectors of each cluster, and the sums of their components."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [0] * k, [[0] * dim for _ in range(k)]
        for batch in batches:
            for _, vectors, *heap in zip(*batch.columns, strict=True):
                vectors = _unpacked(vectors, dim)
                cluster = Heaps.unpack(*[x.as_py() for x in heap]).cluster_of(len(vectors))
                plain = np.abs(vectors).max(initial=0) < 1 << 42  # sums of a block are exact as doubles
                for c in np.unique(cluster).tolist():
                    own = vectors[cluster == c]
                    counts[c] += len(own)
                    total = own.sum(axis=0) if plain else [sum(map(int, column)) for column in own.T]
                    sums[c] = [a + int(b) for a, b in zip(sums[c], total, strict=True)]
        rows = [(c, d, i, str(x)) for c in range(k) if counts[c] for d, total in enumerate([counts[c], *sums[c]]) for i, x in enumerate(_limbs(total))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["c", "d", "limb", "x"])

    found = blocks.mapInArrow(read, "c int, d int, limb int, x string")
    found = found.groupBy("c", "d", "limb").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    totals = [[0] * (dim + 1) for _ in range(k)]
    for r in found.collect():  # k * (dim + 1) rows, a few more for very large sums
        totals[r["c"]][r["d"]] += int(r["x"]) << LIMB * r["limb"]
    return [t[0] for t in totals], [t[1:] for t in totals]


def _limbs(x: int) -> list[int]:
    """Parts of a whole number, each small enough for decimal sums."""
    sign, x, out = (-1 if x < 0 else 1), abs(x), []
    while x:
        out.append(sign * (x & (1 << LIMB) - 1))
        x >>= LIMB
    return out


def moved(before: list[list[int]], after: list[list[int]]) -> list[float]:
    """How much the gap of a vector of each cluster can have shrunk, at most."""
    squared = [sum((a - b) ** 2 for a, b in zip(p, q, strict=True)) for p, q in zip(before, after, strict=True)]
    far = [math.sqrt(s) * (1 + SLACK) if s < 1 << 1000 else 1e300 for s in squared]  # such vectors are scanned anyway
    return [far[c] + max([*far[:c], *far[c + 1:]], default=0.0) for c in range(len(far))]


def starts(rows: DataFrame, k: int, dim: int, scale: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors of smallest hash of their id."""

    def proper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, at = whole_vectors(batch.column(1), dim, scale)
            yield batch.take(pa.array(at))

    kept = rows.where(rows[0].isNotNull()).toDF("id", "vector").mapInArrow(proper, "id long, vector array<double>")
    first = kept.orderBy(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256), "vector").limit(k).collect()
    return [[int(x) for x in np.floor(np.array(r["vector"]) * scale)] for r in first]


def cluster_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
                    dim: int = DIM, scale: int = SCALE, salt: str = "1:") -> tuple[DataFrame, list[list[int]]]:
    """(id, cluster, distance) of each vector after ``rounds`` updates and a last assignment, and the final centroids.

    ``distance`` is a decimal number, as it may be larger than a long.
    """
    rows = df.select(F.col(vec_id).cast("long"), F.col(vector).cast("array<double>"))
    centroids = starts(rows, k, dim, scale, salt)
    if not centroids:
        return rows.select(F.col(vec_id), F.lit(0).alias("cluster"), F.lit(0).cast("decimal(38,0)").alias("distance")).limit(0), []
    held = Round("blocks")
    blocks = held.store(first_blocks(rows, centroids, dim, scale))
    drift = [0.0] * len(centroids)
    for _ in range(rounds):
        counts, sums = cluster_sums(blocks, len(centroids), dim)
        after = [[x // n for x in total] if n else c for n, total, c in zip(counts, sums, centroids, strict=True)]
        drift = [(d + m) * (1 + SLACK) for d, m in zip(drift, moved(centroids, after), strict=True)]
        centroids = after
        blocks = held.store(next_blocks(blocks, centroids, drift, dim))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors, *heap in zip(*batch.columns, strict=True):
                vectors = _unpacked(vectors, dim)
                cluster = Heaps.unpack(*[x.as_py() for x in heap]).cluster_of(len(vectors))
                distance = np.zeros(len(vectors), object)
                for c in np.unique(cluster).tolist():
                    distance[cluster == c] = squared_distances(vectors[cluster == c], [centroids[c]])[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(ids.as_py(), pa.int64()), pa.array(cluster.astype(np.int32)),
                                                  pa.array([str(x) for x in distance])], names=["id", "cluster", "distance"])

    found = blocks.mapInArrow(read, "id long, cluster int, distance string")
    return found.select(F.col("id").alias(vec_id), "cluster", F.expr("try_cast(distance AS decimal(38,0))").alias("distance")), centroids


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"))
    names = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    named = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    sums = found.groupBy("cluster").agg(F.try_sum("distance").alias("own")).toPandas()  # a row for each cluster
    total = sum(int(x) for x in sums["own"]) if sums["own"].notna().all() else None
    of = spark.createDataFrame([(int(c), x) for c, x in zip(sums["cluster"], sums["own"], strict=True)], "cluster int, own decimal(38,0)")
    long = "try_cast({} AS long)".format
    return found.join(F.broadcast(of), "cluster").join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", F.expr(long("distance")).alias("distance"), F.expr(long("own")).alias("cluster_inertia"),
        F.lit(total if total is not None and total < 1 << 63 else None).cast("long").alias("inertia"), "centroid_sha256")


def _round(name: str, source: str) -> str:
    return f"""{name}a AS (SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM
  (SELECT v.vec_id, k.c, list_sum(list_transform(list_zip(v.x, k.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, {source} k) GROUP BY vec_id)"""


def _moved(name: str, source: str) -> str:
    return f"""{name} AS (SELECT c, coalesce(m.x, o.x) AS x FROM {source} o LEFT JOIN (SELECT c, list(s ORDER BY i) AS x FROM
  (SELECT c, i, floor(sum(y) / count(*)::DOUBLE)::BIGINT AS s FROM (SELECT a.c, unnest(v.x) AS y, unnest(range(64)) AS i FROM {name}a a JOIN v USING (vec_id)) GROUP BY c, i)
  GROUP BY c) m USING (c))"""


SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
k0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, x FROM v ORDER BY sha256('1:' || vec_id) LIMIT 16),
{_round('k1', 'k0')}, {_moved('k1', 'k0')}, {_round('k2', 'k1')}, {_moved('k2', 'k1')}, {_round('k3', 'k2')}, {_moved('k3', 'k2')}, {_round('k4', 'k3')},
i AS (SELECT c, sum(d)::BIGINT AS own FROM k4a GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, own AS cluster_inertia, (SELECT sum(own)::BIGINT FROM i) AS inertia,
  sha256(array_to_string(k3.x, ',')) AS centroid_sha256 FROM k4a JOIN i USING (c) JOIN k3 USING (c)
"""
