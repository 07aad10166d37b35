"""Nearest vectors by an inverted multi-index.

Both halves of the unit vectors are quantised with codebooks of their own; a cell is a pair of centroids.
Each query takes the pairs in the order of the summed distances, with a heap, until their cells hold
``share`` of all rows, and is then compared with every row of these cells
in double precision. Codebooks are fitted on a bounded sample of ``SAMPLE`` rows in the order of a
hash; every row is indexed, and the heap goes on over all cells if needed, so no cell is capped.

Rows are cut into blocks of neighbouring cells of about ``BLOCK`` rows, a large cell into several, and each row goes to its
block once. Queries are sent to the blocks they need and stream past the block's rows; a task holds one block at a time,
and returns the best few of each query. Only the sizes of the cells (at most k * k) come to the driver.

Vectors without direction of their own (as spread evenly over a sphere) cannot be pruned much by any
index; ``share`` is set for a recall of 0.9 on such. Clustered data allow a smaller one.

Defined results: vectors that are null, zero, hold null or non-finite numbers, or have another length than most
of the sample, take no part. Repeated rows with equal id and vector are one. Of rows with one id and
several vectors the nearest counts; a query id with several vectors asks with each. Null ids take no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialume.llm.common import smallest_hashes, stored, table

QUERY = "op7_multi_index"
CENTROIDS = 32
SAMPLE = 8192
SHARE = 0.5
BLOCK = 16_384


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows as doubles, and which of them are proper vectors of length ``dim``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out, ok = np.zeros((len(column), dim)), np.zeros(len(column), dtype=bool)
    lengths = np.array([-1 if n is None else n for n in column.value_lengths().to_pylist()], dtype=np.int64)
    right = np.flatnonzero(lengths == dim)
    if len(right):
        flat = column.take(pa.array(right)).flatten().cast(pa.float64())
        values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dim)
        good = np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
        out[right[good]], ok[right[good]] = values[good], True
    return out, ok


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (centroids * centroids).sum(1) - 2 * x @ centroids.T


def codebook(x: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly picked rows."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        of = distances(x, c).argmin(1)
        for j in range(len(c)):
            if (of == j).any():
                c[j] = x[of == j].mean(0)
    return c


def fit(rows: DataFrame, k: int = CENTROIDS) -> dict | None:
    """Both codebooks, or None without any proper vector."""
    sample = smallest_hashes(rows.where("embedding IS NOT NULL"), ["vec_id"], SAMPLE).select("embedding").toArrow()
    column = sample.column("embedding").combine_chunks()
    lengths = pd.Series(column.value_lengths().to_pylist(), dtype="int64")
    lengths = lengths[lengths > 0]
    if lengths.empty:
        return None
    dim = int(lengths.mode().max())
    x, ok = _matrix(column, dim)
    if not ok.any():
        return None
    x, half = unit(x[ok]), dim // 2
    return {"dim": dim, "half": half, "first": codebook(x[:, :half], k), "second": codebook(x[:, half:], k)}


def coded(rows: DataFrame, model: dict) -> DataFrame:
    """vec_id, vector (doubles) and cell of every proper row."""
    wide = len(model["second"])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ok = _matrix(batch.column(1), model["dim"])
            if ok.any():
                x = x[ok]
                u = unit(x)
                cell = distances(u[:, :model["half"]], model["first"]).argmin(1) * wide + distances(u[:, model["half"]:], model["second"]).argmin(1)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * model["dim"], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), vectors, pa.array(cell, pa.int32())], names=["vec_id", "vector", "cell"])

    proper = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long"), "embedding").distinct()
    return proper.mapInArrow(code, "vec_id long, vector array<double>, cell int")


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of the sum of both distances until they hold ``wanted`` rows."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, found, held = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if sizes[cell]:
            found.append(cell)
            held += int(sizes[cell])
        for n in ((i + 1, j), (i, j + 1)):
            if n[0] < len(a) and n[1] < len(b) and n not in seen:
                seen.add(n)
                heapq.heappush(heap, (first[a[n[0]]] + second[b[n[1]]], *n))
    return found


def blocks(sizes: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """First block of each cell, and over how many blocks it is dealt."""
    parts = np.maximum(1, -(-sizes // block))
    first, at, held = np.zeros(len(sizes), dtype=np.int64), 0, 0
    for cell, (n, p) in enumerate(zip(sizes, parts, strict=True)):
        if held and (held + n > block or p > 1):
            at, held = at + 1, 0
        first[cell] = at
        held += n
        if p > 1:
            at, held = at + int(p), 0
    return first, parts


class Block:
    """Rows of one block in the order of their ids, and what queries need of them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, cell: np.ndarray) -> None:
        self.ids, self.x, self.cell = ids, x, cell
        self.u, self.norms = unit(x), np.sqrt((x * x).sum(axis=1))
        self.repeated = len(np.unique(ids)) < len(ids)

    def nearest(self, query_ids: np.ndarray, q: np.ndarray, asked: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        """The best ``k`` ids of each query among the rows whose cell it asks for; equal scores by id."""
        out = []
        scores = np.where(asked[:, self.cell], unit(q) @ self.u.T, -2.0)
        for qid, v, s in zip(query_ids.tolist(), q, scores, strict=True):
            s[self.ids == qid] = -2.0
            n = min(len(s), k)
            least = -1.5 if self.repeated else np.partition(s, len(s) - n)[len(s) - n]  # an id may stand more than once: all rows are ranked
            near = np.flatnonzero(s >= max(least - 1e-9, -1.5))
            exact = (self.x[near] * v).sum(axis=1) / (self.norms[near] * np.sqrt((v * v).sum()))
            order = np.argsort(-exact, kind="stable")
            if self.repeated:
                order = order[np.sort(np.unique(self.ids[near][order], return_index=True)[1])]
            out.extend((qid, int(self.ids[near[o]]), float(exact[o])) for o in order[:k])
        return out


def compared(rows: DataFrame, dim: int, cells: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the best of each block: its rows (``cells`` null) come first, then the queries that ask for it.

    A task holds the rows of one block and a few queries at a time.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for batch in batches:
            blocks, query = batch.column(0).to_numpy(), np.asarray(batch.column(4).is_valid())
            ids, cell = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            x, _ = _matrix(batch.column(2), dim)
            edges = np.flatnonzero(np.concatenate(([True], (blocks[1:] != blocks[:-1]) | (query[1:] != query[:-1]))))
            out = []
            for a, b in zip(edges, [*edges[1:], len(blocks)], strict=True):
                if blocks[a] != now:
                    now, held, block = blocks[a], [], None
                if not query[a]:
                    held.append((ids[a:b], x[a:b], cell[a:b]))
                    continue
                if block is None and held:
                    block = Block(*[np.concatenate(part) for part in zip(*held, strict=True)])
                    held = []
                for at in range(a, b if block else a, 128):
                    to = min(b, at + 128)
                    bits = np.frombuffer(b"".join(batch.column(4).slice(at, to - at).to_pylist()), np.uint8).reshape(to - at, -1)
                    out += block.nearest(ids[at:to], x[at:to], np.unpackbits(bits, axis=1)[:, :cells].astype(bool), k)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))],
                                             names=["query_id", "vec_id", "score"])

    inorder = rows.repartition("block").sortWithinPartitions("block", F.col("cells").isNotNull(), "vec_id")
    return inorder.select("block", "vec_id", "vector", "cell", "cells").mapInArrow(walk, "query_id long, vec_id long, score double")


def search(rows: DataFrame, is_query, k: int = 5, share: float = SHARE, centroids: int = CENTROIDS) -> DataFrame:
    """query_id, rank, vec_id and cosine of the ``k`` nearest found of each row that ``is_query`` picks."""
    spark = rows.sparkSession
    model = fit(rows, centroids)
    if model is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = stored(coded(rows, model), "multi-index")
    cells = len(model["first"]) * len(model["second"])
    sizes = np.zeros(cells, dtype=np.int64)
    for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["cell"]] = r["n"]
    first, parts = blocks(sizes)
    wanted = int(np.ceil(share * sizes.sum()))
    place = F.broadcast(spark.createDataFrame(
        pd.DataFrame({"cell": np.arange(cells, dtype=np.int32), "first": first, "parts": parts}), "cell int, first long, parts long"))
    dealt = index.join(place, "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id", "vector"), "parts")).alias("block"), "vec_id", "vector", "cell")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = _matrix(batch.column(1), model["dim"])
            u = unit(x) if len(x) else x
            bits, to = [], []
            for a, b in zip(distances(u[:, :model["half"]], model["first"]), distances(u[:, model["half"]:], model["second"]), strict=True):
                found = traverse(a, b, sizes, wanted)
                flags = np.zeros(cells, dtype=np.uint8)
                flags[found] = 1
                bits.append(np.packbits(flags).tobytes())
                to.append(sorted({int(first[c]) + i for c in found for i in range(int(parts[c]))}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary()), pa.array(to, pa.list_(pa.int64()))],
                                             names=["query_id", "vector", "cells", "blocks"])

    asked = index.where(is_query).select("vec_id", "vector").mapInArrow(ask, "query_id long, vector array<double>, cells binary, blocks array<long>")
    sent = asked.select(F.explode("blocks").alias("block"), F.col("query_id").alias("vec_id"), "vector", F.lit(-1).alias("cell"), "cells")
    found = compared(dealt.withColumn("cells", F.lit(None).cast("binary")).unionByName(sent), model["dim"], cells, k)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


SQL = None  # approximate; tests/llm measures recall against brute force
