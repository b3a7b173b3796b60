"""Alignment of two tokenizers over the same texts, and counts of linked id pairs over the corpus.

A is a byte-level BPE in the library's JSON form, B a piece model; both see a blank and the text (B puts
the blank itself). A token covers bytes; tokens of A and B whose bytes overlap are linked, and offsets where
both have an end cut a text into groups.

All texts of a batch are merged in lockstep: one state vector holds the current A and B token of every
text, each step emits their links, compares the two ends, emits a cut where they are equal, advances the side
that ends first (or both), and finished texts leave the vector. A long text takes several places in the
vector, which begin where it is known to have a cut, so the number of steps doesn't grow with its length.

Counts of pairs are gathered per batch, then over the corpus by partial aggregates. A batch is stored with its links
as numbers of its own list of pairs; the list (far shorter than the links) is joined to the counts, comes back
in order, and the batch's texts get their sums. Links are never moved one by one, and a pair that occurs
everywhere is one row per batch.

Defined cases: NULL and empty texts, and texts whose tokens' bytes aren't a blank and the text on either side (such as
those with the piece model's own mark for blanks), have no tokens: zeros and an empty digest; texts of blanks alone are
like any other; equal rows count twice; a NULL id is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from milepost.llm import byte_bpe
from milepost.llm.common import steps, texts_of
from milepost.session import cut_lineage

#: A tokens between two places of one text in the state vector, and how many are tried for a cut.
LANE, TRIES = 256, 16
#: Words and pieces kept by a task, and the longest that is kept (in characters).
KNOWN, KEPT = 300_000, 40
MARK = "▁"


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones for themselves, then from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Table:
    """Bytes of ids of words or pieces, kept in two generations of bounded size."""

    def __init__(self):
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, split: list[list[str]], encode) -> list[np.ndarray]:
        """The ids of each text from those of its parts; ``encode`` gives ids of parts not known yet."""
        table = self.known
        new = set().union(*split).difference(table)
        for p in new.intersection(self.older):
            table[p] = self.older[p]
        new = list(new.difference(table))
        table.update(zip(new, (array("i", x).tobytes() for x in encode(new))))
        out = [np.frombuffer(b"".join(map(table.__getitem__, parts)), "<i4") for parts in split]
        if len(table) > KNOWN:
            self.older = {p: x for p, x in table.items() if len(p) <= KEPT}
            self.known = {}
        return out


class ByteLevel:
    """Encoder of a byte-level vocabulary with listed merges; special strings are plain text."""

    def __init__(self, path: str, classes: np.ndarray):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        self.bytes = [b""] * (max(model["vocab"].values()) + 1)
        for token, number in model["vocab"].items():
            if all(c in letters for c in token):
                self.bytes[number] = bytes(letters[c] for c in token)
        number = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [number[a + b] for a, b in pairs]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("ids of merged tokens must ascend in the order of the merges")
        self.merger = byte_bpe.Merger.__new__(byte_bpe.Merger)
        self.merger.ranks = {}  # merges alone decide, as in the library
        self.merger.single = [number[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merger.pair = {number[a] << 32 | number[b]: k for (a, b), k in zip(pairs, made)}
        self.classes = classes
        self.table = Table()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = byte_bpe.pieces(texts, self.classes)
        return self.table.ids(split, lambda new: [self.merger.merge(p.encode()) for p in new])


class Pieces:
    """Encoder of a piece model; by words where no piece crosses one.

    ``encode`` also tells which texts their tokens' bytes give back. Words are compared when they enter the table; a
    text with the mark itself never is what its tokens say.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(k) else n.replace(MARK, " ").encode()
            for k, n in enumerate(names)
        ]
        probe = "  aÄﬁ  b 　 c "
        self.by_word = not any(MARK in n.lstrip(MARK) for n in names) and self.model.decode(self.model.encode(probe)) == probe
        self.words = re.compile(f"{MARK}+[^{MARK}]*").findall
        self.table, self.strange = Table(), set()

    def _same(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == text.replace(MARK, " ").encode()

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        # the library puts the first mark itself; a lone mark would be empty text to it
        lone = [self.model.piece_to_id(MARK)]
        found = [x or lone for x in self.model.encode([w[1:] for w in words], num_threads=1)]
        self.strange.update(w for w, ids in zip(words, found) if not self._same(ids, w))
        return found

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        if not self.by_word:
            found = self.model.encode(texts, num_threads=1)
            good = [MARK not in t and self._same(x, f" {t}") for x, t in zip(found, texts)]
            return [np.array(x, "<i4") for x in found], good
        split = [self.words(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        ids = self.table.ids(split, self._encode_words)
        strange = self.strange
        good = [MARK not in t and not (strange and strange.intersection(words)) for t, words in zip(texts, split)]
        return ids, good


def _lanes(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray):
    """First A and B tokens of every place in the state vector, and the A token before which it stops.

    Texts have their first tokens in ``a_first`` and ``b_first``; a longer one is also entered after ends that A and B share.
    """
    n = np.diff(a_first)
    many = np.maximum(n - TRIES, 0) // LANE
    text = np.repeat(np.arange(len(n)), many)
    at = a_first[:-1][text] + LANE * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many) + 1)
    found_a, found_b = [a_first[:-1][n > 0]], [b_first[:-1][n > 0]]
    for k in range(TRIES):
        if not len(at):
            break
        other = np.searchsorted(b_end, a_end[at + k])
        shared = b_end[np.minimum(other, len(b_end) - 1)] == a_end[at + k]
        found_a.append(at[shared] + k + 1)
        found_b.append(other[shared] + 1)
        at = at[~shared]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(a)
    a, b = a[order], b[order]
    return a, b, np.append(a[1:], a_first[-1])


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray):
    """Links (A token, B token) and cuts (last A and B token of a group), in no order.

    ``a_end`` and ``b_end`` are the tokens' ends in all texts laid end to end; texts end at both.
    """
    a, b, stop = _lanes(a_end, b_end, a_first, b_first)
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        ends_a, ends_b = a_end[a], b_end[b]
        cut = ends_a == ends_b
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a = a + (ends_a <= ends_b)
        b = b + (ends_b <= ends_a)
        open_ = a < stop
        if not open_.all():
            a, b, stop = a[open_], b[open_], stop[open_]
    empty = np.zeros(0, np.int64)
    return tuple(np.concatenate([empty, *x]) for x in (links_a, links_b, cuts_a, cuts_b))


def _names(count: int) -> np.ndarray:
    """Decimal numbers and a separator as eight bytes: rows 3k, 3k + 1, 3k + 2 end in ``,``, ``|``, ``;``."""
    lines = [f"{k}{s}".encode().ljust(8, b"\0") for k in range(count) for s in ",|;"]
    return np.frombuffer(b"".join(lines), "<u8")


def group_texts(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, cuts_a: np.ndarray,
                cuts_b: np.ndarray, names: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text: ids of A and B by group."""
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[cuts_a], last_b[cuts_b] = 1, 1
    ends_a, ends_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    # before a token lie all of the other side's tokens in earlier groups; B comes after A in its own
    place_a = np.arange(len(a)) + np.append(0, ends_b + 1)[group_a]
    place_b = np.arange(len(b)) + ends_a[group_b] + 1
    cells = np.empty(len(a) + len(b), "<u8")
    cells[place_a] = names[3 * a.astype(np.int64) + last_a]
    cells[place_b] = names[3 * b.astype(np.int64) + 2 * last_b]
    raw = cells.view(np.uint8).reshape(-1, 8)
    full = raw != 0
    ends = np.append(0, np.cumsum(full.sum(axis=1)))
    text = raw[full].tobytes()
    cut = ends[a_first + b_first].tolist()
    return [text[x : max(x, y - 1)] for x, y in zip(cut, cut[1:])]


class Aligner:
    """Both encoders and their vocabularies' bytes."""

    def __init__(self, a_path: str, b_path: str, classes: np.ndarray):
        self.a, self.b = ByteLevel(a_path, classes), Pieces(b_path)
        self.a_size = np.array([len(x) for x in self.a.bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b.bytes], np.int64)
        self.names = _names(max(len(self.a_size), len(self.b_size)))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text on both sides; none where the bytes of a side aren't a blank and the text.

        (On the byte level they always are: pieces cover the text, and every byte has an id.)
        """
        a = self.a.encode([f" {t}" if t else "" for t in texts])
        b, good = self.b.encode(texts)
        none = np.zeros(0, "<i4")
        for k in [k for k, fine in enumerate(good) if not fine]:
            a[k] = b[k] = none
        return a, b

    def batch(self, texts: list[str]) -> dict:
        """Measures of each text, the batch's distinct pairs with their links, and each link's pair by text."""
        ids_a, ids_b = self.encode(texts)
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (ids_a, ids_b))
        a, b = np.concatenate([*ids_a, np.zeros(0, "<i4")]), np.concatenate([*ids_b, np.zeros(0, "<i4")])
        a_first, b_first = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
        links_a, links_b, cuts_a, cuts_b = lockstep(
            np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), a_first, b_first
        )
        text_of = np.repeat(np.arange(len(texts)), n_a)
        link_text = text_of[links_a]
        order = np.argsort(link_text.astype(np.uint16) if len(texts) <= 1 << 16 else link_text, kind="stable")
        keys = a[links_a[order]].astype(np.int64) << 32 | b[links_b[order]]
        pairs, which, n = np.unique(keys, return_inverse=True, return_counts=True)
        groups = group_texts(a, b, a_first, b_first, cuts_a, cuts_b, self.names)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(text_of[cuts_a], minlength=len(texts)),
            "n_links": np.bincount(link_text, minlength=len(texts)),
            "groups": groups, "pairs": pairs, "n": n, "which": which,
        }


@functools.lru_cache(1)
def aligner_of(a_path: str, b_path: str, classes: bytes) -> Aligner:
    """One aligner per worker process, whose tables outlive a task."""
    return Aligner(a_path, b_path, byte_bpe.class_array(classes))


def _packed(which: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all low bytes first."""
    planes = np.ascontiguousarray(which.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
_BATCH = (
    "doc_id array<long>, " + ", ".join(f"{m} array<long>" for m in MEASURES)
    + ", groups_sha256 array<string>, links binary, pairs array<long>, n array<long>"
)


def _align_batches(a_path: str, b_path: str, classes: bytes):
    def run(batches):
        aligner = aligner_of(a_path, b_path, classes)
        for batch in steps(batches):
            got = aligner.batch(batch.column("text").to_pylist())
            sha = [hashlib.sha256(g).hexdigest() if g else "" for g in got["groups"]]
            columns = {
                "doc_id": pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                **{m: pa.array([got[m]], pa.list_(pa.int64())) for m in MEASURES},
                "groups_sha256": pa.array([sha], pa.list_(pa.string())),
                "links": pa.array([_packed(got["which"])], pa.binary()),
                "pairs": pa.array([got["pairs"]], pa.list_(pa.int64())), "n": pa.array([got["n"]], pa.list_(pa.int64())),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by batch and pair: first the stored batch itself, then a row per pair."""

    def flush(head: dict, totals: list[np.ndarray], best: list[np.ndarray]) -> pa.RecordBatch:
        n_links = np.array(head["n_links"], np.int64)
        which = _unpacked(head["links"], int(n_links.sum()))
        text = np.repeat(np.arange(len(n_links)), n_links)
        total, hit = (np.concatenate([np.zeros(0, np.int64), *x])[which] for x in (totals, best))
        # sums of numbers below 2**63 in whole numbers
        sums = np.append(0, np.cumsum(total))[np.append(0, np.cumsum(n_links))]
        hits = np.bincount(text, hit, len(n_links)).astype(np.int64)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(head["doc_id"], pa.int64()), **{m: pa.array(head[m], pa.int64()) for m in MEASURES},
            "n_best": pa.array(hits), "count_sum": pa.array(np.diff(sums)),
            "groups_sha256": pa.array(head["groups_sha256"], pa.string()),
        })

    head, totals, best = None, [], []
    for batch in batches:
        place = batch.column("place").to_numpy()
        heads = np.flatnonzero(place < 0).tolist()
        for a, b in zip([0, *heads], [*heads, len(place)]):
            if a < b and place[a] < 0:
                if head is not None:
                    yield flush(head, totals, best)
                columns = ["doc_id", *MEASURES, "groups_sha256", "links"]
                head, totals, best = batch.slice(a, 1).select(columns).to_pylist()[0], [], []
                a += 1
            if a < b:
                totals.append(batch.column("total").slice(a, b - a).to_numpy())
                best.append(batch.column("best").slice(a, b - a).to_numpy())
    if head is not None:
        yield flush(head, totals, best)


RESULT = (
    "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", n_best long, count_sum long, groups_sha256 string"
)


def aligned_batches(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per batch of texts: their measures, its distinct pairs with numbers of links, and its links."""
    found = texts_of(docs, id_col, text_col).mapInArrow(
        _align_batches(a_path, b_path, byte_bpe.packed_classes()), _BATCH
    )
    return cut_lineage(found.withColumn("batch", F.monotonically_increasing_id()), "aligned", "zstd")


def pair_counts(stored: DataFrame) -> DataFrame:
    """a, b, links and best (whether no A id has more links with b) of every linked id pair of the corpus."""
    listed = stored.select(F.explode(F.arrays_zip("pairs", "n")).alias("x")).select("x.pairs", "x.n")
    counts = cut_lineage(listed.groupBy("pairs").agg(F.sum("n").alias("links")), "pair-counts")
    b = F.col("pairs").bitwiseAND(F.lit((1 << 32) - 1))
    most = cut_lineage(counts.groupBy(b.alias("b")).agg(F.max("links").alias("most")), "most-links")
    named = counts.select("pairs", F.shiftright("pairs", 32).alias("a"), b.alias("b"), "links")
    return cut_lineage(
        named.join(most, "b").select("pairs", "a", "b", "links", (F.col("links") == F.col("most")).alias("best")),
        "ranked-pairs",
    )


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = aligned_batches(docs, a_path, b_path, id_col, text_col)
    ranked = pair_counts(stored)
    listed = stored.select("batch", F.posexplode("pairs").alias("place", "pairs"))
    kept = ["doc_id", *MEASURES, "groups_sha256", "links"]
    blank = [F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in kept]
    found = listed.join(ranked, "pairs").select(
        "batch", "place", F.col("links").alias("total"), F.col("best").cast("long").alias("best"), *blank
    )
    heads = stored.select(
        "batch", F.lit(-1).alias("place"), F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("best"), *kept
    )
    return (
        heads.union(found).repartition(tasks, "batch").sortWithinPartitions("batch", "place")
        .mapInArrow(_sum_batches, RESULT)
    )
