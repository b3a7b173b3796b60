"""Near duplicates by exact similarity: sets of word shingles with a Jaccard similarity of at least 0.8.

Rows with equal sets form one class first. Sets as similar as that differ in about ten of 64 SimHash
bits, where blocks of equal bits are so short that groups grow with the table. So fingerprints meet
under other keys: ``BANDS`` keys of ``DEEP`` minima of permuted shingle hashes, of which two sets of
similarity 0.8 share one with a chance of 0.99997 (of 0.3 in one of seven pairs, unlike ones
practically never). Under a key, bit planes (`simhash.Planes`) find what is within ``RADIUS`` bits, and each of
those is confirmed by the exact similarity of the sets before it counts as a link. The group is walked
breadth-first over confirmed links. Links come from exact similarities only; a pair is lost only if it shares no key or
differs in over ``RADIUS`` bits.

Keys with the same members are worked on once. A key with more than ``PART`` shingles is dealt out to
parts, each walked by itself; keys whose members are not in one component after that are dealt to pairs of parts
(each with each), so a task holds two parts at most and no pair is lost.

Defined cases: NULL and empty texts have the empty set and form one class; fewer words than a shingle
form one shingle; equal rows share a class; rows with a NULL id are kept, and are the one that stays only if
no other row has an id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from milepost.llm.common import Words, numbered, steps, texts_of, utf8
from milepost.llm.components import connected_components
from milepost.llm.simhash import WORD, Planes, majority, row_key, shingle_hashes
from milepost.session import cut_lineage

#: Words of a shingle, and the least similarity in hundredths.
SHINGLE, PERCENT = 5, 80
#: Keys of a set, and minima of a key.
BANDS, DEEP = 20, 4
#: Fingerprint bits beyond which sets are not compared; unlike sets differ in 32 on average.
RADIUS = 26
#: Shingles of one part of a key.
PART = 1 << 19
#: Keys whose links a task hands on at once.
LINK_GROUPS = 2000

_ODD = np.random.default_rng(42).integers(0, 1 << 32, (BANDS, DEEP), np.uint32) | np.uint32(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
SKETCH = "sid long, fingerprint long, n_shingles long, keys array<long>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one text after the other, and their numbers."""
    hashes, many = shingle_hashes(words, size)
    ends = np.cumsum(many)
    for a, b in zip((ends - many).tolist(), ends.tolist()):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[(ends - many)[many > 0]] = True
    return hashes[new], np.diff(np.append(0, np.cumsum(new))[np.append(0, ends)])


def set_ids(sets: np.ndarray, many: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    total = np.append(np.uint64(0), np.cumsum(_mixed(sets), dtype=np.uint64))
    ends = np.cumsum(many)
    return _mixed(total[ends] - total[ends - many] + many.astype(np.uint64))


def band_keys(sets: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``BANDS`` keys of each set that is not empty."""
    many = many[many > 0]
    keys = np.zeros((len(many), BANDS), np.uint64)
    if not len(many):
        return keys
    low, base = sets.astype(np.uint32), np.cumsum(many) - many
    permuted = np.empty_like(low)
    for band in range(BANDS):
        for odd in _ODD[band]:
            np.multiply(low, odd, out=permuted)
            keys[:, band] = _mixed(keys[:, band] + np.minimum.reduceat(permuted, base) + _MIX)
    return keys


def sketch_arrays(words: Words, size: int) -> list[pa.Array]:
    """The columns of ``SKETCH`` for the words of some texts."""
    sets, many = shingle_sets(words.lower(), size)
    keys = band_keys(sets, many)
    offsets = np.append(0, np.cumsum(np.where(many > 0, BANDS, 0))).astype(np.int32)
    return [
        pa.array(set_ids(sets, many).view(np.int64)), pa.array(majority(sets, many).view(np.int64)), pa.array(many),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64).ravel())),
    ]


def _sketch_batches(size: int):
    def run(batches):
        for batch in steps(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rk"), *sketch_arrays(Words(utf8(batch)), size)],
                ["doc_id", "rk", "sid", "fingerprint", "n_shingles", "keys"],
            )

    return run


def _keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return texts_of(docs, id_col, text_col).withColumn("rk", row_key())


def sketches(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, rk (a key of id and text), and name, fingerprint, size and keys of the set of every row."""
    return _keyed_texts(docs, id_col, text_col).mapInArrow(_sketch_batches(shingle), f"doc_id long, rk long, {SKETCH}")


def _set_batches(size: int):
    def run(batches):
        for batch in steps(batches):
            sets, many = shingle_sets(Words([t.lower() for t in utf8(batch)]), size)
            ends = np.cumsum(many)
            held = [sets[a:b].tobytes() for a, b in zip(ends - many, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(set_ids(sets, many).view(np.int64)), pa.array(held, pa.binary())], ["sid", "shingles"]
            )

    return run


def confirmed_links(prints: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links (positions) that connect all sets whose similarity is at least ``percent`` hundredths.

    The bits in common only save exact comparisons; few rows are told apart by xor, many by bit planes.
    """
    planes = Planes(prints) if len(prints) >= WORD else None
    todo = np.ones(len(sets), bool)
    sizes = np.array([len(s) for s in sets])
    links = []
    for seed in range(len(sets)):
        if not todo[seed]:
            continue
        todo[seed] = False
        queue = [seed]
        while queue and todo.any():
            at = queue.pop()
            if planes is None:
                found = np.flatnonzero(todo & (np.bitwise_count(prints ^ prints[at]) <= RADIUS))
            else:
                found = planes.within(int(prints[at]), RADIUS, planes.bitmap(todo))
            # sizes too far apart rule a pair out
            found = found[100 * np.minimum(sizes[found], sizes[at]) >= percent * np.maximum(sizes[found], sizes[at])]
            if not len(found):
                continue
            own, others = sets[at], np.concatenate([sets[k] for k in found])
            hit = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes[found]) - sizes[found])
            found = found[100 * both >= percent * (sizes[found] + sizes[at] - both)]
            todo[found] = False
            links += [(at, int(k)) for k in found]
            queue += found.tolist()
    return links


def _link_batches(percent: int):
    def links_of(held: list[pa.RecordBatch]) -> np.ndarray:
        """Linked set names of one key."""
        t = pa.Table.from_batches(held)
        sid = t.column("sid").to_numpy()
        prints = t.column("fingerprint").to_numpy().view(np.uint64)
        sets = [np.frombuffer(s, np.uint64) for s in t.column("shingles").to_pylist()]
        return sid[np.array(confirmed_links(prints, sets, percent), np.int64).reshape(-1, 2)]

    def out(found: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *found])
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches):
        held, last, found = [], None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.column_stack([batch.column(c).to_numpy() for c in ("band", "key", "part")])
            cut = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))).tolist()
            for a, b in zip(cut, [*cut[1:], len(key)]):
                if held and (key[a] != last).any():
                    found.append(links_of(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = key[a]
            if len(found) > LINK_GROUPS:  # keys are many and small: their links go on together
                yield out(found)
                found = []
        if held:
            found.append(links_of(held))
        yield out(found)

    return run


def similar_roots(docs: DataFrame, sketched: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """node, root: sets of ``sketched`` that are linked to others, and the name of their component.

    ``sketched`` are the stored `sketches` of ``docs``, whose texts are read again for sets that share a key.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = F.struct("rk", "fingerprint", "n_shingles", "keys")
    classes = cut_lineage(sketched.groupBy("sid").agg(F.min(own).alias("own")).select("sid", "own.*"), "set-classes")
    keyed = classes.select("sid", "fingerprint", "n_shingles", F.posexplode("keys").alias("band", "key"))
    crowd = (
        keyed.groupBy("band", "key")
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("held"), F.bit_xor(F.xxhash64("sid")).alias("who"))
        .filter("n > 1").withColumn("parts", F.ceil(F.col("held") / PART))
        .groupBy("n", "held", "parts", "who").agg(F.min(F.struct("band", "key")).alias("at"))
        .select("at.band", "at.key", "parts")
    )
    members = cut_lineage(
        keyed.join(crowd, ["band", "key"]).withColumn("mine", F.pmod(F.xxhash64("sid"), F.col("parts"))), "key-members"
    )
    wanted = members.select("sid").distinct().join(classes, "sid").select("rk")
    sets = cut_lineage(
        _keyed_texts(docs, id_col, text_col).join(wanted, "rk", "left_semi")
        .mapInArrow(_set_batches(shingle), "sid long, shingles binary").dropDuplicates(["sid"]), "shingle-sets",
    )

    def links(dealt: DataFrame) -> DataFrame:
        found = (
            dealt.join(sets, "sid").select("band", "key", "part", "sid", "fingerprint", "shingles")
            .repartition(tasks, "band", "key", "part").sortWithinPartitions("band", "key", "part")
            .mapInArrow(_link_batches(percent), "a long, b long")
        )
        return cut_lineage(found, "similar-links")

    near = links(members.withColumn("part", F.col("mine")))
    roots = connected_components(near)
    wide = members.filter("parts > 1")
    if wide.isEmpty():
        return roots
    rooted = wide.join(roots, wide.sid == roots.node, "left").withColumn("root", F.coalesce("root", "sid"))
    apart = rooted.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    # part pairs that hold a set: its own part with every other
    pairs = F.expr(
        "transform(filter(sequence(0L, parts - 1), o -> o <> mine), o -> least(o, mine) * parts + greatest(o, mine))"
    )
    across = wide.join(apart.select("band", "key"), ["band", "key"], "left_semi").withColumn("part", F.explode(pairs))
    return connected_components(near.union(links(across)))


def drop_similar(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component, the one with the least id (then text key), all columns."""
    sketched = cut_lineage(sketches(docs, shingle), "sketches")
    roots = similar_roots(docs, sketched, shingle, percent)
    row = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rk")).alias("least")
    # rows of one set first, so that a large class is one row in the join
    least = sketched.groupBy("sid").agg(row)
    stay = (
        least.join(roots, least.sid == roots.node, "left").groupBy(F.coalesce("root", "sid").alias("root"))
        .agg(F.min("least").alias("least"))
        .select(F.coalesce("least.doc_id", F.lit(0)).alias("k1"), F.col("least.rk").alias("k2"))
    )
    named, at = numbered(docs)
    keyed = named.withColumn("k1", F.coalesce(F.col(at["doc_id"]).cast("long"), F.lit(0))).withColumn(
        "k2", row_key(at["doc_id"], at["text"])
    )
    left = keyed.join(stay, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return left.select(*named.columns).toDF(*docs.columns)
