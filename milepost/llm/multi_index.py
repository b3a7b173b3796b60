"""Approximate nearest neighbours by an inverted multi-index, cosine.

Vectors are scaled to length 1 and cut into halves; each half has its own codebook (k-means on a
bounded sample), and a pair of centroids is a cell. A query walks the pairs by the sum of the two
squared distances, taken from a heap, until the cells hold ``share`` of all rows and at least
``least``. The rows of these cells are ranked by the exact cosine of the original vectors.

Cells are cut into blocks of rows, and the queries that visit a cell into groups; every block meets
every group of its cell in one task, so a cell with a third of all rows, or one that all queries visit,
is many tasks of bounded size. A block answers with its best ``k`` for each query.

Defined cases: vectors that are NULL, of another length than most, zero, or hold NULL or non-finite
components take no part, neither as queries nor as rows; equal scores go to the smaller id; rows with
one id are rows of their own, and a query meets none with its own id; fewer rows than ``k`` give them
all; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from milepost.session import cut_lineage

#: Rows of a block, and queries of a group.
BLOCK, QUERIES = 2048, 1024


def usable(column: str) -> Column:
    """Whether a vector can be compared."""
    return F.expr(
        f"`{column}` IS NOT NULL AND size(`{column}`) > 0"
        f" AND NOT exists(`{column}`, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
        f" AND exists(`{column}`, x -> x <> 0)"
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def kmeans(points: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids; the first ones are spread over the order of the first coordinates' sum."""
    order = np.argsort(points.sum(axis=1), kind="stable")
    centres = points[order[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)]].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sizes = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return distances(points, centres).argmin(axis=1)


class Codebooks:
    """The two codebooks."""

    def __init__(self, sample: np.ndarray, k: int):
        points = unit(sample)
        self.half = points.shape[1] // 2
        self.first = kmeans(points[:, : self.half], k)
        self.second = kmeans(points[:, self.half :], k)
        self.cells = len(self.first) * len(self.second)

    def cell_of(self, vectors: np.ndarray) -> np.ndarray:
        points = unit(vectors)
        a = nearest(points[:, : self.half], self.first)
        return a * len(self.second) + nearest(points[:, self.half :], self.second)

    def walk(self, vector: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
        """Cells by summed distance until they hold ``enough`` rows; empty cells are passed over."""
        point = unit(vector[None, :])
        d1 = distances(point[:, : self.half], self.first)[0]
        d2 = distances(point[:, self.half :], self.second)[0]
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        d1, d2 = d1[o1].tolist(), d2[o2].tolist()
        heap, seen, out, held = [(d1[0] + d2[0], 0, 0)], {(0, 0)}, [], 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            cell = int(o1[i]) * len(d2) + int(o2[j])
            if sizes[cell]:
                out.append(cell)
                held += int(sizes[cell])
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(d1) and b < len(d2) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (d1[a] + d2[b], a, b))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _cells(books: Codebooks):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cell = books.cell_of(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return run


def _walks(books: Codebooks, sizes: np.ndarray, enough: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [books.walk(v, sizes, enough) for v in _matrix(batch.column("v"))]
            at = np.repeat(np.arange(len(found)), list(map(len, found)))
            cells = np.array([c for x in found for c in x], np.int64)
            for lo in range(0, len(at), 4096):
                own = batch.take(pa.array(at[lo : lo + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("v"), pa.array(cells[lo : lo + 4096])], ["id", "v", "cell"]
                )

    return run


#: Pairs whose exact cosines are worked out at once.
PAIRS = 16_384


def best_of(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """Query, row and exact cosine of each query's best ``k`` rows in a block, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    rough = unit(queries) @ unit(rows).T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    if rough.shape[1] > k:
        bar = np.partition(rough, -k, axis=1)[:, -k]
        keep = rough >= bar[:, None] - 1e-9
    else:
        keep = np.ones(rough.shape, bool)
    q, r = np.nonzero(keep & np.isfinite(rough))
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    norm_q, norm_r, exact = norm(queries), norm(rows), np.empty(len(q))
    for lo in range(0, len(q), PAIRS):  # on ties a block may keep every pair
        a, b = q[lo : lo + PAIRS], r[lo : lo + PAIRS]
        exact[lo : lo + PAIRS] = (queries[a] * rows[b]).sum(axis=1) / (norm_q[a] * norm_r[b])
    by = np.lexsort((ids[r], -exact, q))
    q, r, exact = q[by], r[by], exact[by]
    first = np.searchsorted(q, q)
    top = np.arange(len(q)) - first < k
    return q[top], r[top], exact[top], ids


def _match(k: int):
    def flush(held: list[pa.RecordBatch]):
        t = pa.Table.from_batches(held).combine_chunks()
        asks = t.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        key = np.column_stack([t.column(c).to_numpy() for c in ("cell", "block", "grp")])
        ids = t.column("id").to_numpy()
        v = _matrix(t.column("v").combine_chunks())
        cut = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        out = [[], [], []]
        for a, b in zip(cut, np.append(cut[1:], len(key))):
            own = np.arange(a, b)
            qs, rs = own[asks[a:b]], own[~asks[a:b]]
            if len(qs) and len(rs):
                q, r, exact, sorted_ids = best_of(v[qs], ids[qs], v[rs], ids[rs], k)
                for c, x in zip(out, (ids[qs][q], sorted_ids[r], exact)):
                    c.append(x)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query_id", "vec_id", "score"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= BLOCK:
                key = np.column_stack([batch.column(c).to_numpy() for c in ("cell", "block", "grp")])
                last = [held[-1].column(c)[-1].as_py() for c in ("cell", "block", "grp")]
                change = np.flatnonzero((key != last).any(axis=1))
                stop = int(change[0]) if len(change) else batch.num_rows
                held.append(batch.slice(0, stop))
                rows += stop
                batch = batch.slice(stop)
                if not batch.num_rows:
                    continue
                yield from flush(held)
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if rows:
            yield from flush(held)

    return run


def _deal(df: DataFrame, own: str, own_count: str, own_size: int, other: str, other_count: str, other_size: int,
          asks: bool) -> DataFrame:
    """Puts rows of a cell into parts and repeats each for all parts of the other side."""
    parts = F.ceil(F.col(own_count) / own_size)
    return df.select(
        "cell", "id", "v", F.lit(asks).alias("asks"),
        F.pmod(F.xxhash64("id", "v"), parts).alias(own),
        F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(other_count) / other_size) - 1)).alias(other),
    ).select("cell", "id", "v", "asks", "block", "grp")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, centroids: int = 16, share: float = 0.6,
                       least: int = 1000, sample_rows: int = 10_000, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score. ``queries`` has the same columns as ``vectors``.

    The codebooks are fitted on up to ``sample_rows`` vectors, chosen by a hash of the id; all rows
    are indexed. Recall grows with ``share``, the part of the rows that a query's cells must hold.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        return df.filter(usable(vector_col) & F.col(f"`{id_col}`").isNotNull()).select(
            F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
        )

    rows, asked = clean(vectors), clean(queries)
    schema = "query_id long, rank int, vec_id long, score double"
    usual = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if usual is None:
        return spark.createDataFrame([], schema)
    rows, asked = (x.filter(F.size("v") == usual["d"]) for x in (rows, asked))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").collect()
    books = Codebooks(np.array([r["v"] for r in sample], float), centroids)
    index = cut_lineage(rows.mapInArrow(_cells(books), "id long, v array<double>, cell long"), "cells")
    sizes = np.zeros(books.cells, np.int64)
    for cell, n in index.groupBy("cell").count().collect():  # centroids^2 numbers at most
        sizes[cell] = n
    enough = max(least, int(np.ceil(share * sizes.sum())))
    visits = cut_lineage(
        asked.mapInArrow(_walks(books, sizes, enough), "id long, v array<double>, cell long"), "visits"
    )
    counts = (
        index.groupBy("cell").agg(F.count("*").alias("n"))
        .join(visits.groupBy("cell").agg(F.count("*").alias("m")), "cell")
    )
    counts = F.broadcast(counts)  # centroids^2 rows at most
    dealt = _deal(index.join(counts, "cell"), "block", "n", BLOCK, "grp", "m", QUERIES, False).unionByName(
        _deal(visits.join(counts, "cell"), "grp", "m", QUERIES, "block", "n", BLOCK, True)
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = (
        dealt.repartition(tasks, "cell", "block", "grp").sortWithinPartitions("cell", "block", "grp")
        .mapInArrow(_match(k), "query_id long, vec_id long, score double")
    )
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
