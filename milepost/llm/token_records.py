"""Token ids as length-delimited binary records with checksums and an offset index.

A data set is a folder of shards and a manifest. A shard holds, after an 8-byte header, one record
per document: 8 bytes length, 4 bytes masked CRC-32 of the length, the payload, 4 bytes masked
CRC-32 of the payload; a payload is one byte (1: the document has an id), 8 bytes id and the token
ids, two bytes each where the vocabulary allows, otherwise four. Its index file holds the 8-byte offset of every record, so
that a reader can fetch records in any order. All numbers are little-endian.

Documents are range-partitioned and sorted by (id, text); shard numbers follow that order. A task
writes its shard under a name of its own, and the manifest, written by the same tasks through
Spark's committer, lists the files of the attempts that counted: lost or repeated attempts leave
files that nobody reads.

Defined cases: NULL and empty texts give a record with the end id alone; a NULL id is kept and sorts
first; rows with one id follow each other by text; an empty table gives an empty manifest; other
columns are ignored. A damaged record stops the reader with an error.
"""

from __future__ import annotations

import copy
import functools
import os
import string
import struct
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from milepost.llm.common import Words, steps, texts_of, utf8

MAGIC = b"MPREC1"
HEAD, FIELDS = "<QI", "<Bq"
HEAD_BYTES, FIELD_BYTES = struct.calcsize(HEAD), struct.calcsize(FIELDS)
#: Words kept by a worker process (about 40 bytes each) before it begins anew.
KNOWN_WORDS = 1_500_000
#: Words that the library gets as one text.
JOINED = 200
#: ASCII marks that begin no piece with a letter, as the apostrophe does.
MARKS = np.isin(np.arange(256), np.frombuffer(string.punctuation.replace("'", "").encode(), np.uint8))
#: Documents that a reader hands on at once.
READ_ROWS = 500
#: Bytes of input files for one shard, at most: more input makes more shards.
SHARD_INPUT = 128 << 20
MANIFEST = "shard long, file string, n_records long, n_tokens long"


def masked(crc: int) -> int:
    """A checksum of data that itself holds checksums should not be one of those: rotate and add."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def units(raw: list[bytes], words: Words | None = None) -> tuple[Words, np.ndarray]:
    """The texts' words as they are looked up, and which of them are small letters alone.

    In texts without ``<|``, words of ASCII and Latin-1 letters alone are lower-cased, and a run of ``MARKS`` that
    ends a word after such a letter is a unit of its own: the tokenizer always splits there, and nothing composes over it.
    """
    words = copy.copy(words or Words(raw))
    buf, start, end = words.buf, words.start, words.end
    # a Latin-1 letter is C3 and a second byte
    second = np.append(False, buf[:-1] == 0xC3) & (buf != 0x97) & (buf != 0xB7)
    latin = second | np.append(second[1:], False)
    big = (buf >= 65) & (buf <= 90)
    letter = latin | big | (buf >= 97) & (buf <= 122)
    # 32 bits hold the places, for a text has less than 2 GB
    other = np.append(np.int32(0), np.cumsum((buf >= 128) & ~latin, dtype=np.int32))
    whole = np.array([b"<|" not in t for t in raw], bool)[words.doc()]
    plain = whole & (other[end] == other[start])
    at = np.flatnonzero(big | second & (buf <= 0x9E))
    words.buf = buf.copy()
    words.buf[at[plain[np.searchsorted(start, at, side="right") - 1]]] |= 32

    last = np.maximum.accumulate(np.where(MARKS[buf], np.int32(-1), np.arange(len(buf), dtype=np.int32)))
    stem = np.maximum(last[end - 1] + 1, start)
    cut = whole & (stem > start) & (stem < end) & letter[stem - 1]
    ends = np.cumsum(1 + cut)
    words.first = np.append(0, ends)[words.first]
    tail = ends[cut] - 1
    words.start, words.end = np.repeat(start, 1 + cut), np.repeat(end, 1 + cut)
    words.start[tail] = words.end[tail - 1] = stem[cut]
    letters = np.append(np.int32(0), np.cumsum(letter, dtype=np.int32))
    only = letters[words.end] - letters[words.start] == words.end - words.start
    return words, only & np.repeat(plain, 1 + cut)


class WordEncoder:
    """Ids of whole texts from a bounded table of their words.

    The tokenizer collapses white space and drops it before merging, and neither normalising nor
    special strings reach over a blank. So a text's ids are those of its words one after another. To have
    fewer kinds, words of ASCII and Latin-1 letters alone are lower-cased; others keep their case, since the tokenizer composes
    letters and marks first and some pairs have a composed form in small letters only. Marks that end a word are looked up apart.
    (Texts with the beginning of a special string, which is found before lower-casing, are left as they are.)

    The library gets new words of small letters alone ``JOINED`` at a time, joined by blanks: a call for each costs twice
    as much. Such a word has one id with the model's end-of-word suffix, its last; where that doesn't hold, and for all other words, there
    is a call for each.

    The table is a sorted array of word hashes with the place of each word's ids in one long array, so
    that a slice of texts is looked up and put together without a step per word. Two words of the
    table or of a slice would share a 64-bit hash with a chance of about 1 in 10^8.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        vocab = self.library.get_vocab() if suffix else {}
        self.last = np.zeros(max(vocab.values(), default=-1) + 1, bool)  # ids that end a word
        self.last[[k for token, k in vocab.items() if token.endswith(suffix)]] = True
        self.kind = np.dtype(f"<u{width}")
        self.hash = np.zeros(0, np.uint64)
        self.start = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.kind)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hash, hashes), max(0, len(self.hash) - 1))
        return self.hash[at] == hashes if len(self.hash) else np.zeros(len(hashes), bool)

    def _library_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after another, and their numbers."""
        found = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), self.kind, int(size.sum())), size

    def _word_ids(self, words: list[str], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after another, and their numbers; ``plain`` words are small letters alone."""
        if plain and len(self.last):
            ids, _ = self._library_ids([" ".join(words[k : k + JOINED]) for k in range(0, len(words), JOINED)])
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(words) and (not len(words) or ends[-1] == len(ids)):
                return ids, np.diff(np.append(0, ends))
        return self._library_ids(words)

    def _add(self, hashes: np.ndarray, words: list[str], plain: np.ndarray) -> None:
        order = np.argsort(~plain, kind="stable")
        parts = np.split(order, [int(plain.sum())])
        found = [self._word_ids([words[k] for k in part.tolist()], kind) for part, kind in zip(parts, (True, False))]
        size = np.concatenate([x[1] for x in found])
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *(x[0] for x in found)])
        hashes = np.concatenate([self.hash, hashes[order]])
        order = np.argsort(hashes, kind="stable")
        self.hash = hashes[order]
        self.start = np.concatenate([self.start, start])[order]
        self.size = np.concatenate([self.size, size])[order]

    def _places(self, raw: list[bytes], words: Words | None) -> tuple[Words, np.ndarray]:
        """The units of the texts and the place of each in the table."""
        words, plain = units(raw, words)
        kinds, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.hash) > KNOWN_WORDS:
            self.hash, self.start, self.size, self.ids = self.hash[:0], self.start[:0], self.size[:0], self.ids[:0]
        new = np.flatnonzero(~self._known(kinds))
        if len(new):
            whole = words.buf.tobytes()
            at = first[new]
            spans = zip(words.start[at].tolist(), words.end[at].tolist())
            self._add(kinds[new], [whole[a:b].decode() for a, b in spans], plain[at])
        return words, np.searchsorted(self.hash, kinds)[number]

    def encode(self, raw: list[bytes], words: Words | None = None) -> list[bytes]:
        """The ids of each text as little-endian bytes; ``words`` are those of the texts, if they are there already."""
        words, at = self._places(raw, words)
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.start[at] - (ends - size), size) + np.arange(total)]
        cuts = np.append(0, ends)[words.first].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def counts(self, raw: list[bytes], words: Words | None = None) -> np.ndarray:
        """The number of ids of each text."""
        words, at = self._places(raw, words)
        return np.diff(np.append(0, np.cumsum(self.size[at]))[words.first])


@functools.lru_cache(1)
def encoder_of(path: str, width: int) -> WordEncoder:
    """The encoder of this worker process; its table serves one task after the other."""
    return WordEncoder(path, width)


def id_width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def _write_shard(folder: str, path: str, end_id: int, width: int):
    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        offsets, at, tokens = [], 8, 0
        end = end_id.to_bytes(width, "little")
        with files.open_output_stream(f"{root}/{name}.rec") as out:
            out.write(MAGIC + struct.pack("<H", width))
            for batch in steps(batches):
                found = encoder_of(path, width).encode(utf8(batch))
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found):
                    body = struct.pack(FIELDS, doc_id is not None, doc_id or 0) + ids + end
                    size = struct.pack("<Q", len(body))
                    out.write(size + struct.pack("<I", masked(zlib.crc32(size))))
                    out.write(body)
                    out.write(struct.pack("<I", masked(zlib.crc32(body))))
                    offsets.append(at)
                    at += HEAD_BYTES + len(body) + 4
                    tokens += len(ids) // width + 1
        with files.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(np.array(offsets, "<u8").tobytes())
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "file": [name], "n_records": [len(offsets)], "n_tokens": [tokens]}
        )

    return run


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a DataFrame reads, from their listing (what is no file counts nothing)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    nodes = [leaves.apply(k) for k in range(leaves.size())]
    return sum(int(n.stats().sizeInBytes()) for n in nodes if n.nodeName() == "LogicalRelation")


def write_records(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", shards: int | None = None) -> None:
    """Encodes every row and writes the data set to ``folder``, a shared folder (local, HDFS, S3).

    Without ``shards`` there is one for every ``SHARD_INPUT`` bytes of the files read, and at least
    ``spark.sql.shuffle.partitions``.
    """
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards or max(least, -(-input_bytes(docs) // SHARD_INPUT))
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)
    (
        texts_of(docs, id_col, text_col)
        .repartitionByRange(shards, F.col("doc_id"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(_write_shard(folder, path, end_id, id_width(path)), MANIFEST)
        .write.parquet(f"{folder}/manifest")
    )


def width_of(file) -> int:
    """Bytes of one token id in a shard."""
    head = file.read_at(len(MAGIC) + 2, 0)
    if head[: len(MAGIC)] != MAGIC:
        raise ValueError("no shard of token records")
    return struct.unpack_from("<H", head, len(MAGIC))[0]


def record_at(file, offset: int, width: int) -> tuple[int | None, np.ndarray]:
    """Id and token ids of the record at an offset; checks both checksums."""
    head = file.read_at(HEAD_BYTES, offset)
    size, crc = struct.unpack(HEAD, head)
    if crc != masked(zlib.crc32(head[:8])):
        raise ValueError(f"damaged length at offset {offset}")
    body = file.read_at(size + 4, offset + HEAD_BYTES)
    if len(body) != size + 4 or struct.unpack("<I", body[-4:])[0] != masked(zlib.crc32(body[:-4])):
        raise ValueError(f"damaged record at offset {offset}")
    known, doc_id = struct.unpack_from(FIELDS, body)
    return (doc_id if known else None), np.frombuffer(body[FIELD_BYTES:-4], f"<u{width}")


def read_index(files, root: str, name: str) -> np.ndarray:
    """Offsets of a shard's records."""
    with files.open_input_file(f"{root}/{name}.idx") as f:
        return np.frombuffer(f.read(), "<u8")


def _read_shards(folder: str, row, kinds: dict):
    def run(batches):
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for line in batch.to_pylist():
                offsets = read_index(files, root, line["file"])
                if len(offsets) != line["n_records"]:
                    raise ValueError(f"index of {line['file']} has {len(offsets)} of {line['n_records']} records")
                before, rows = line["before"], []
                with files.open_input_file(f"{root}/{line['file']}.rec") as f:
                    width = width_of(f)
                    for offset in offsets.tolist():
                        doc_id, ids = record_at(f, offset, width)
                        rows.append((doc_id, before, *row(ids)))
                        before += len(ids)
                        if len(rows) == READ_ROWS:
                            yield _batch(rows, kinds)
                            rows = []
                yield _batch(rows, kinds)

    return run


def _batch(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))


def _read(spark: SparkSession, folder: str, row, extra: dict, schema: str) -> DataFrame:
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # one row per shard: the running total is a small sort
    before = F.sum("n_tokens").over(Window.orderBy("shard")) - F.col("n_tokens")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), manifest.count())
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), **extra}
    return (
        manifest.withColumn("before", before).repartition(shards, "file")
        .mapInArrow(_read_shards(folder, row, kinds), "doc_id long, start long, " + schema)
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (token ids before the record in the data set) and ids of every record."""
    return _read(spark, folder, lambda ids: (ids.astype(np.int64),), {"ids": pa.list_(pa.int64())}, "ids array<long>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit integers."""
    return _read(
        spark, folder, lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())),
        {"n_tokens": pa.int64(), "ids_crc32": pa.int64()}, "n_tokens long, ids_crc32 long",
    )
