"""Shared pieces: tables, Arrow batches of bounded size, word arrays and vectorised XXH64."""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows and bytes that Spark hands to a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return small_batches(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def small_batches(df: DataFrame) -> DataFrame:
    """The same rows; from here on the session hands them to Python workers in small batches."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def text_column(text_col: str) -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text (NULL as empty), whatever else the table holds."""
    return small_batches(docs).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_column(text_col).alias("text")
    )


def steps(batches: Iterator[pa.RecordBatch], limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose ``text`` column has about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        step = size // limit
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def utf8(batch: pa.RecordBatch) -> list[bytes]:
    """The texts of a slice as bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(batch.column("text").type) else pa.binary()
    return batch.column("text").cast(kind).to_pylist()


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows with columns c0, c1, ... (so that names can't clash), and the name of each."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))


def filtered(docs: DataFrame, good, text_col: str = "text") -> DataFrame:
    """The rows whose texts ``good(texts, raw)`` marks, with all columns; NULL is judged as empty text."""
    named, at = numbered(small_batches(docs))
    columns = named.columns

    def run(batches):
        for batch in steps(batches):
            marks = pa.array(good(batch.column("text").to_pylist(), utf8(batch)))
            yield batch.select(columns).filter(marks)

    judged = named.withColumn("text", text_column(at[text_col]))
    return judged.mapInArrow(run, named.schema).toDF(*docs.columns)


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of several texts, laid out in one buffer.

    ``buf`` holds each text's words joined by one space, texts joined by a line feed, and 40 zero
    bytes. Word ``i`` is ``buf[start[i]:end[i]]``; text ``d`` has words ``first[d]:first[d + 1]``.
    (``bytes.split`` without an argument splits at exactly those six characters.)
    """

    def __init__(self, texts: list[bytes]):
        joined = [b" ".join(t.split()) for t in texts]
        raw = b"\n".join(joined)
        self.joined = joined
        self.buf = np.frombuffer(raw + bytes(40), np.uint8)
        body = self.buf[: len(raw)]
        ends = np.append(np.flatnonzero((body == 32) | (body == 10)), len(raw))
        starts = np.append(0, ends[:-1] + 1)
        full = ends > starts
        self.start, self.end = starts[full], ends[full]
        sizes = np.array([len(j) for j in joined], np.int64)
        base = np.append(0, np.cumsum(sizes + 1))[:-1]
        self.first = np.append(np.searchsorted(self.start, base), len(self.start))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def lower(self) -> Words:
        """The same words with A-Z lower-cased (in ``buf``)."""
        out = copy.copy(self)
        out.buf = self.buf | ((self.buf >= 65) & (self.buf <= 90)).astype(np.uint8) << np.uint8(5)
        return out

    def hashes(self) -> np.ndarray:
        """XXH64 of each word."""
        return xxh64(self.buf, self.start, self.end - self.start)


# XXH64's published constants; fixed values.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)


def _rot(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _lane(acc: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _rot(acc + word * _P2, 31) * _P1


def xxh64(buf: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of many byte spans of one buffer, which ends in at least 8 spare bytes."""
    n = len(start)
    if not n:
        return np.zeros(0, np.uint64)
    u64 = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    u32 = np.ndarray((len(buf) - 3,), "<u4", buf, 0, (1,))
    seed = np.uint64(seed)
    pos, left = start.astype(np.int64), size.astype(np.int64)
    with np.errstate(over="ignore"):
        h = np.full(n, seed + _P5)
        long = np.flatnonzero(left >= 32)
        if len(long):
            at, rest = pos[long], left[long]
            lanes = [_lane(s, u64[at + 8 * k]) for k, s in enumerate((seed + _P1 + _P2, seed + _P2, seed, seed - _P1))]
            at += 32
            rest -= 32
            open_ = np.flatnonzero(rest >= 32)
            while len(open_):
                for k in range(4):
                    lanes[k][open_] = _lane(lanes[k][open_], u64[at[open_] + 8 * k])
                at[open_] += 32
                rest[open_] -= 32
                open_ = open_[rest[open_] >= 32]
            acc = sum(_rot(lane, r) for lane, r in zip(lanes, (1, 7, 12, 18)))
            for lane in lanes:
                acc = (acc ^ _lane(np.uint64(0), lane)) * _P1 + _P4
            h[long], pos[long], left[long] = acc, at, rest
        h += size.astype(np.uint64)
        for _ in range(3):
            i = np.flatnonzero(left >= 8)
            if not len(i):
                break
            word = u64[pos[i]]
            h[i] = _rot(h[i] ^ _lane(np.uint64(0), word), 27) * _P1 + _P4
            pos[i] += 8
            left[i] -= 8
        i = np.flatnonzero(left >= 4)
        h[i] = _rot(h[i] ^ (u32[pos[i]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        pos[i] += 4
        left[i] -= 4
        for _ in range(3):
            i = np.flatnonzero(left > 0)
            if not len(i):
                break
            h[i] = _rot(h[i] ^ (buf[pos[i]].astype(np.uint64) * _P5), 11) * _P1
            pos[i] += 1
            left[i] -= 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))
