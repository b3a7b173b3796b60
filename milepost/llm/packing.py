"""Best-fit packing of documents into sequences, under conflicts.

A sequence (bin) holds at most one document of a source and one of a duplicate cluster, a component of
near duplicates (`similar`: five-word shingles, similarity 0.8 or more). Pieces, the
longest first, go to the tightest bin that has room and no conflict: bins are kept ordered by what is
left in them, the search begins at the first bin with room (the successor of the piece's length) and
goes on to ever roomier ones until a bin's bitmaps of sources and clusters have neither of the piece's
bits; if none is found, a new bin is opened.

Documents longer than a bin are cut; full pieces fill bins of their own, the rest is packed. Pieces
are dealt by a hash to shards of about ``SHARD`` pieces, each packed by itself: their number grows
with the data, the memory of a task does not, and hot sources and clusters spread evenly.

Defined cases: NULL and empty texts have length 0 and still get a place; a NULL source conflicts with
nothing; repeated rows are packed one by one; pieces of equal length go by id, piece and cluster; rows with a NULL id are kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from milepost.llm import similar
from milepost.llm.common import Words, small_batches, steps, text_column, utf8
from milepost.llm.simhash import row_key
from milepost.llm.token_records import encoder_of, id_width
from milepost.session import cut_lineage

#: Pieces that are packed together.
SHARD = 8192
#: Most Spark partitions that shards are dealt to; a task packs its shards one after another.
TASKS = 20_000
#: Bins that one step of the search looks at.
LOOK = 128


class Bins:
    """Bins of one shard, ordered by the room that is left."""

    def __init__(self, capacity: int, pieces: int, sources: int, clusters: int):
        self.capacity = capacity
        self.left = np.empty(pieces, np.int64)  # ordered
        self.bin = np.empty(pieces, np.int64)  # in the same order
        self.n = 0
        self.sources = np.zeros((pieces, -(-sources // 64)), np.uint64)
        self.clusters = np.zeros((pieces, -(-clusters // 64)), np.uint64)

    @staticmethod
    def _has(bits: np.ndarray, bins: np.ndarray, k: int) -> np.ndarray:
        return (bits[bins, k >> 6] >> np.uint64(k & 63) & np.uint64(1)).astype(bool)

    def put(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin of a piece and its place there; source or cluster -1 conflicts with nothing."""
        lo = int(np.searchsorted(self.left[: self.n], length))
        for a in range(lo, self.n, LOOK):
            bins = self.bin[a : min(a + LOOK, self.n)]
            clash = np.zeros(len(bins), bool)
            if source >= 0:
                clash |= self._has(self.sources, bins, source)
            if cluster >= 0:
                clash |= self._has(self.clusters, bins, cluster)
            k = int(clash.argmin())
            if not clash[k]:
                at, own, room = a + k, int(bins[k]), int(self.left[a + k])
                break
        else:
            at, own, room = self.n, self.n, self.capacity
            self.n += 1
        to = int(np.searchsorted(self.left[:at], room - length))
        self.left[to + 1 : at + 1] = self.left[to:at].copy()
        self.bin[to + 1 : at + 1] = self.bin[to:at].copy()
        self.left[to], self.bin[to] = room - length, own
        if source >= 0:
            self.sources[own, source >> 6] |= np.uint64(1 << (source & 63))
        if cluster >= 0:
            self.clusters[own, cluster >> 6] |= np.uint64(1 << (cluster & 63))
        return own, self.capacity - room


def _shared(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers for values that occur more than once, -1 for others (they cannot conflict)."""
    out = np.full(len(values), -1)
    if known.any():
        _, number, count = np.unique(values[known], return_inverse=True, return_counts=True)
        dense = np.cumsum(count > 1) - 1
        out[known] = np.where(count[number] > 1, dense[number], -1)
    return out, int(out.max(initial=-1)) + 1


def pack_shard(lengths: np.ndarray, sources: np.ndarray, has_source: np.ndarray, clusters: np.ndarray,
               capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in the bin of each piece, in the given order."""
    source, n_sources = _shared(sources, has_source)
    cluster, n_clusters = _shared(clusters, np.ones(len(clusters), bool))
    bins = Bins(capacity, len(lengths), n_sources, n_clusters)
    placed = [bins.put(*x) for x in zip(lengths.tolist(), source.tolist(), cluster.tolist())]
    out = np.array(placed, np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def _measure(path: str):
    """Token counts, and the shingle sets' sketches."""
    width = id_width(path)

    def run(batches):
        for batch in steps(batches):
            raw = utf8(batch)
            words = Words(raw)
            counts = encoder_of(path, width).counts(raw, words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rk"), batch.column("source"), pa.array(counts),
                 *similar.sketch_arrays(words, similar.SHINGLE)],
                ["doc_id", "rk", "source", "n_tokens", "sid", "fingerprint", "n_shingles", "keys"],
            )

    return run


def measured(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source (hash or NULL), n_tokens and cluster (component of near duplicates) of every row."""
    source = F.col(f"`{source_col}`").cast("string")
    rows = small_batches(docs).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_column(text_col).alias("text"),
        F.when(source.isNotNull(), F.xxhash64(source)).alias("source"),
    ).withColumn("rk", row_key())
    found = rows.mapInArrow(_measure(path), f"doc_id long, rk long, source long, n_tokens long, {similar.SKETCH}")
    found = cut_lineage(found, "measured")
    roots = similar.similar_roots(docs, found, id_col=id_col, text_col=text_col)
    return found.join(roots, found.sid == roots.node, "left").select(
        "doc_id", "source", "n_tokens", F.coalesce("root", "sid").alias("cluster")
    )


def _pack_batches(capacity: int):
    def flush(held):
        t = pa.Table.from_batches(held)
        col = {c: t.column(c).to_numpy() for c in ("shard", "n_tokens", "cluster")}
        source = t.column("source")
        has = source.is_valid().to_numpy()
        source = source.fill_null(0).to_numpy()
        cut = np.flatnonzero(np.append(True, col["shard"][1:] != col["shard"][:-1]))
        bins, places = [], []
        for a, b in zip(cut, np.append(cut[1:], len(has))):
            bin_, place = pack_shard(col["n_tokens"][a:b], source[a:b], has[a:b], col["cluster"][a:b], capacity)
            bins.append((col["shard"][a] << 32) + bin_)
            places.append(place)
        out = t.select(["doc_id", "piece", "first_token", "n_tokens"])
        out = out.append_column("bin_id", pa.array(np.concatenate(bins)))
        yield from out.append_column("place", pa.array(np.concatenate(places))).combine_chunks().to_batches()

    def run(batches):
        held = []
        for batch in batches:
            while batch.num_rows:
                last = held[-1].column("shard")[-1].as_py() if held else batch.column("shard")[0].as_py()
                change = np.flatnonzero(batch.column("shard").to_numpy() != last)
                stop = int(change[0]) if len(change) else batch.num_rows
                if stop:
                    held.append(batch.slice(0, stop))
                batch = batch.slice(stop)
                if batch.num_rows:
                    yield from flush(held)
                    held = []
        if held:
            yield from flush(held)

    return run


def pack(items: DataFrame, capacity: int, tasks: int = TASKS) -> DataFrame:
    """Packs rows of doc_id, source, n_tokens, cluster in at most ``tasks`` tasks.

    Gives doc_id, piece, first_token (of the document), n_tokens, bin_id and place (tokens before the
    piece in its bin).
    """
    whole = F.floor(F.col("n_tokens") / capacity)
    pieces = items.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n_tokens") / capacity) - 1, F.lit(0)))).alias("piece")
    ).select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("first_token"),
        F.when(F.col("piece") < whole, F.lit(capacity).cast("long")).otherwise(F.col("n_tokens") % capacity).alias("n_tokens"),
        "source", "cluster",
    )
    pieces = cut_lineage(pieces, "pieces")
    shards = max(1, -(-pieces.count() // SHARD))
    shard: Column = F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(shards))
    return (
        pieces.withColumn("shard", shard)
        .repartition(min(shards, tasks), "shard")
        .sortWithinPartitions("shard", F.desc("n_tokens"), "doc_id", "piece", "cluster")
        .mapInArrow(_pack_batches(capacity), "doc_id long, piece long, first_token long, n_tokens long, bin_id long, place long")
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """Counts tokens with the tokenizer at ``path``, names duplicate clusters, and packs."""
    return pack(measured(docs, path, id_col, text_col, source_col), capacity)
