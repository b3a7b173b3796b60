"""SimHash near-duplicates: fingerprints, links within a radius, components.

Fingerprints are the majority bits of the XXH64 of all word shingles, counted in byte lanes of 64-bit
words. Equal fingerprints form one class first. Links between different fingerprints within the
radius are found exactly: of ``radius + 2`` blocks of bits, two are equal in any linked pair, so every
pair of blocks is a key and linked fingerprints meet under one of the keys. Under a key, fingerprints
are stored vertically, one bit plane of the group per bit; the distances of one fingerprint to all
others come from carry-save counters over the planes, eight planes at a time, and the rest is
abandoned as soon as every counter is beyond the radius. A group is walked breadth-first, so it
gives a spanning forest and never all pairs. Groups of less than a machine word share one set of planes, which is
compared with itself moved by 1, 2, ... rows: all groups of a batch at once, masked to rows of one group.

A key with more fingerprints than ``GROUP`` is dealt out to pairs of parts (each part with each), so
no task gets more than two parts, and no pair is lost.

Defined cases: NULL and empty texts have fingerprint 0 and are linked like any other; fewer words
than a shingle form one shingle; equal rows share a class; rows with a NULL id are kept, and do not
become a component's id unless no other row has one; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from milepost.llm.common import Words, numbered, steps, text_column, texts_of, utf8, xxh64
from milepost.llm.components import connected_components
from milepost.session import cut_lineage

#: Fingerprints of one part of a key.
GROUP = 4096
#: Rows of sorted keys that a task works on at once; groups are never cut.
ROWS = 50_000
WORD = 64


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every shingle, and the number of shingles of each text."""
    counts = words.counts
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), many)
    at = words.first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    last = at + np.minimum(size, counts[doc]) - 1
    start = words.start[at]
    return xxh64(words.buf, start, words.end[last] - start), many


def majority(hashes: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Per text, the bits set in over half of its hashes; eight byte lanes count up to 255 hashes."""
    out = np.zeros(len(many), np.uint64)
    full = np.flatnonzero(many)
    if not len(full):
        return out
    sizes = many[full]
    base = np.cumsum(sizes) - sizes
    runs = -(-sizes // 255)
    first_run = np.cumsum(runs) - runs
    inside = np.arange(runs.sum()) - np.repeat(first_run, runs)
    cuts = np.repeat(base, runs) + 255 * inside
    ones = np.uint64(0x0101010101010101)
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(shift)) & ones, cuts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first_run, axis=0)
        for byte in range(8):
            bit = np.uint64(8 * byte + shift)
            out[full] |= (2 * counts[:, byte] > sizes).astype(np.uint64) << bit
    return out


def _fingerprint_batches(size: int):
    def run(batches):
        for batch in steps(batches):
            found = majority(*shingle_hashes(Words([t.lower() for t in utf8(batch)]), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rk"), pa.array(found.view(np.int64))],
                ["doc_id", "rk", "fingerprint"],
            )

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, rk (a key of id and text) and fingerprint (the 64 bits as a long) of every row."""
    return texts_of(docs, id_col, text_col).withColumn("rk", row_key()).mapInArrow(
        _fingerprint_batches(shingle), "doc_id long, rk long, fingerprint long"
    )


def row_key(id_col: str = "doc_id", text_col: str = "text"):
    """Tells rows with one id apart by their texts."""
    return F.xxhash64(F.col(id_col).cast("long"), text_column(text_col))


class Planes:
    """The bits of a group of fingerprints, one plane of the group per bit."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        rows = -(-n // WORD) * WORD
        bits = np.zeros((rows, 64), np.uint8)
        bits[:n] = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        self.planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")
        self.open = np.packbits(np.arange(rows) < n, bitorder="little").view("<u8")

    def bitmap(self, rows: np.ndarray) -> np.ndarray:
        """Marked rows as a bitmap of the planes' length."""
        whole = np.zeros(64 * len(self.open), bool)
        whole[: len(rows)] = rows
        return np.packbits(whole, bitorder="little").view("<u8")

    def within(self, value: int, radius: int, among: np.ndarray) -> np.ndarray:
        """Positions of the rows ``among`` (a bitmap) at up to ``radius`` bits from a value."""
        flips = np.array([-(value >> b & 1) & 0xFFFFFFFFFFFFFFFF for b in range(64)], np.uint64)
        return _near(lambda eight: self.planes[eight : eight + 8] ^ flips[eight : eight + 8, None], radius, among)

    def near_later(self, shift: int, radius: int, among: np.ndarray) -> np.ndarray:
        """Positions of the rows ``among`` at up to ``radius`` bits from the row ``shift`` places (1 to 63) later.

        Every row of the planes is compared with its own partner at once: the planes are xored with
        themselves, moved by ``shift`` bits.
        """
        down, up = np.uint64(shift), np.uint64(WORD - shift)

        def differ(eight: int) -> np.ndarray:
            own = self.planes[eight : eight + 8]
            later = own >> down
            later[:, :-1] |= own[:, 1:] << up
            return own ^ later

        return _near(differ, radius, among)


def _near(differ, radius: int, among: np.ndarray) -> np.ndarray:
    """Positions of the rows ``among`` (a bitmap) with up to ``radius`` differing bits.

    ``differ(b)`` gives eight bitmaps of the rows that differ in bits b to b + 7. Counters are kept in binary,
    one bitmap per digit, and stop at the first number beyond the radius: ``over`` remembers the rows that
    got there. The other planes are abandoned when no row is left.
    """
    digits = radius.bit_length()
    count = [np.zeros_like(among) for _ in range(digits)]
    over = ~among
    for eight in range(0, 64, 8):
        bits = differ(eight)
        # carry-save: three bitmaps of one weight give a sum and a carry
        ones, twos = _save(bits[0], bits[1], bits[2])
        ones, c2 = _save(ones, bits[3], bits[4])
        ones, c3 = _save(ones, bits[5], bits[6])
        ones, c4 = ones ^ bits[7], ones & bits[7]
        twos, fours = _save(twos, c2, c3)
        twos, f2 = twos ^ c4, twos & c4
        fours, eights = fours ^ f2, fours & f2
        for k, added in enumerate((ones, twos, fours, eights)):
            for d in range(k, digits):
                count[d], added = count[d] ^ added, count[d] & added
            over |= added
        beyond = np.zeros_like(over)
        equal = ~beyond
        for d in reversed(range(digits)):
            if radius >> d & 1:
                equal &= count[d]
            else:
                beyond |= equal & count[d]
                equal &= ~count[d]
        over |= beyond
        if not (~over).any():
            return np.zeros(0, np.int64)
    return np.flatnonzero(np.unpackbits((~over).view(np.uint8), bitorder="little"))


def _save(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def spanning_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (positions) that connect what lies within the radius of each other; no row is asked twice."""
    group = Planes(values)
    todo = group.open.copy()
    numbers = values.tolist()
    links = []
    for seed in range(len(values)):
        if not int(todo[seed >> 6]) >> (seed & 63) & 1:
            continue
        todo[seed >> 6] ^= np.uint64(1 << (seed & 63))
        queue = [seed]
        while queue:
            at = queue.pop()
            found = group.within(numbers[at], radius, todo)
            np.bitwise_and.at(todo, found >> 6, ~(np.uint64(1) << (found & 63).astype(np.uint64)))
            links += [(at, int(k)) for k in found]
            queue += found.tolist()
    return links


def links_in(keys: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Linking pairs of values among rows sorted by key."""
    cut = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
    sizes = np.diff(np.append(cut, len(keys)))
    left, right = [], []
    group = np.repeat(np.arange(len(cut)), sizes)
    small = np.repeat(sizes < WORD, sizes)
    # small groups lie side by side in one set of planes, each row against the next, the one after it, ...
    few = values[small]
    of = group[small]
    planes = Planes(few) if len(few) else None
    for shift in range(1, min(WORD, int(sizes[sizes < WORD].max(initial=0)))):
        partner = np.zeros(len(few), bool)
        partner[:-shift] = of[shift:] == of[:-shift]
        at = planes.near_later(shift, radius, planes.bitmap(partner))
        left.append(few[at])
        right.append(few[at + shift])
    for k in np.flatnonzero(sizes >= WORD):
        own = np.unique(values[cut[k] : cut[k] + sizes[k]])
        found = np.array(spanning_links(own, radius), np.int64).reshape(-1, 2)
        left.append(own[found[:, 0]])
        right.append(own[found[:, 1]])
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _link_batches(radius: int):
    def flush(keys, values):
        a, b = links_in(np.concatenate(keys), np.concatenate(values), radius)
        differ = a != b
        return pa.RecordBatch.from_arrays(
            [pa.array(a[differ].view(np.int64)), pa.array(b[differ].view(np.int64))], ["a", "b"]
        )

    def run(batches):
        keys, values, rows = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.column_stack([batch.column(c).to_numpy() for c in ("band", "key", "part")])
            value = batch.column("fingerprint").to_numpy().view(np.uint64)
            if rows >= ROWS:  # rows are sorted by key: what came before the last key is complete
                last = key[0]
                change = np.flatnonzero((key != last).any(axis=1))
                stop = int(change[0]) if len(change) else len(key)
                keys.append(key[:stop])
                values.append(value[:stop])
                key, value = key[stop:], value[stop:]
                rows += stop
                if not len(key):
                    continue
                yield flush(keys, values)
                keys, values, rows = [], [], 0
            keys.append(key)
            values.append(value)
            rows += len(key)
        if rows:
            yield flush(keys, values)

    return run


def _block_keys(radius: int) -> list:
    """For each pair of blocks, a key made of both blocks' bits."""
    n = radius + 2
    edges = [64 * k // n for k in range(n + 1)]
    block = [
        F.shiftrightunsigned("fingerprint", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))
        for lo, hi in zip(edges, edges[1:])
    ]
    return [F.shiftleft(block[i], 32).bitwiseOR(block[j]) for i, j in combinations(range(n), 2)]


def near_links(classes: DataFrame, radius: int) -> DataFrame:
    """Links a, b that connect all fingerprints within ``radius`` bits, from distinct fingerprints."""
    if radius < 1:
        return classes.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    keyed = classes.select(
        "fingerprint", F.posexplode(F.array(*_block_keys(radius))).alias("band", "key")
    )
    crowd = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / GROUP)
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("parts"))
    # part pairs that hold this row: its own part with every other (and with itself, if alone)
    pairs = F.expr(
        "CASE WHEN parts = 1 THEN array(0L) ELSE transform(filter(sequence(0L, parts - 1), o -> o <> mine),"
        " o -> least(o, mine) * parts + greatest(o, mine)) END"
    )
    dealt = (
        keyed.join(crowd, ["band", "key"]).withColumn("parts", parts).withColumn("mine", mine)
        .select("fingerprint", "band", "key", F.explode(pairs).alias("part"))
    )
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(tasks, "band", "key", "part")
        .sortWithinPartitions("band", "key", "part")
        .mapInArrow(_link_batches(radius), "a long, b long")
    )


def _rooted(prints: DataFrame, radius: int) -> DataFrame:
    """fingerprint, first (its least row) and root of every class; ``first`` holds id and key of a row."""
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rk")
    classes = cut_lineage(prints.groupBy("fingerprint").agg(F.min(row).alias("first")), "fingerprint-classes")
    roots = connected_components(near_links(classes.select("fingerprint"), radius))
    return classes.join(roots, classes.fingerprint == roots.node, "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (long) and component_id, the smallest id that can be reached, of every row."""
    prints = cut_lineage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    rooted = _rooted(prints, radius)
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(least, "root").select("fingerprint", F.col("least.doc_id").alias("component_id"))
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` for each component, the one with the least id (then text key), all columns."""
    prints = cut_lineage(fingerprints(docs, shingle), "fingerprints")
    stay = _rooted(prints, radius).groupBy("root").agg(F.min("first").alias("least")).select(
        F.coalesce("least.doc_id", F.lit(0)).alias("k1"), F.col("least.rk").alias("k2")
    )
    named, at = numbered(docs)
    keyed = named.withColumn("k1", F.coalesce(F.col(at["doc_id"]).cast("long"), F.lit(0))).withColumn(
        "k2", row_key(at["doc_id"], at["text"])
    )
    left = keyed.join(stay, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return left.select(*named.columns).toDF(*docs.columns)


def hex_of(fingerprint: str = "fingerprint"):
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
