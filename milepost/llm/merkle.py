"""Merkle manifest of a table: a DAG of digests, proofs by descent, and verification.

Each row is a leaf, the SHA-256 (lower-case hex) of its fields, each as byte count, ``:`` and value
(``-`` if NULL). Within a source, leaves ascend by id; while several nodes are left, every 16 consecutive
ones become the hash of their digests. What is left is the source's subroot, and the subroots in order of their
sources give the root in the same way.

Inner nodes are kept as records of a digest and its children's digests, so content addresses them and equal
nodes are one record. A request is a leaf's place: the rank of its source and its rank there. Written in
base 16, the ranks are the way down: from the root, each step joins the nodes that have requests below
them to their records, follows the digits, and appends the children not taken to the path. A step holds one row
per requested node, so what leaves have in common is looked up once and a hot source is no hot key. The last
step meets the leaves, sixteen at a time. A path read backwards is a leaf's proof.

Ranks come from a range sort by source, id, digest and row: Spark samples the bounds, so a source with a third of the rows
is spread over many partitions, and the counts of (partition, source) give what lies before a partition.

Defined cases: NULL ids and sources come first; rows with one id are ordered by digest, equal rows are leaves of their own;
NULL fields are ``-``, empty ones ``0:``; an empty table has no rows and no records; a table of one row has its leaf
as root and the hash of nothing as proof; other columns are ignored, and so are their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from milepost.session import cut_lineage

#: Bits of a digit of a rank, and children of a node.
BITS = 4
FANOUT = 1 << BITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """Byte count and value of one field, ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns: list[Column]) -> Column:
    """The leaf digest (bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def hashed(digests: Column) -> Column:
    """The digest of some digests, which go in as hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(joined(digests))), 256))


def joined(digests: Column) -> Column:
    """An array of digests as one run of bytes."""
    return F.aggregate(digests, F.lit(b""), lambda acc, x: F.concat(acc, x))


def hex_of(digest: str) -> Column:
    return F.lower(F.hex(digest))


def leaves_of(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """id, src (bytes that sort like the source, NULL first), leaf and altered of every row.

    ``altered`` is the leaf of the same row with A-Z of the text in small letters where ``tampered`` holds,
    else the leaf. The texts are read once.
    """
    columns = [F.col(f"`{c}`") for c in FIELDS]
    text = F.translate(columns[-1].cast("string"), _UPPER, _LOWER)
    leaf = leaf_of(columns)
    hit = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    source = columns[1].cast("string")
    return docs.select(
        columns[0].cast("long").alias("id"),
        F.when(source.isNull(), F.lit(b"")).otherwise(F.concat(F.lit(b"\x01"), source.cast("binary"))).alias("src"),
        leaf.alias("leaf"), F.when(hit, leaf_of([*columns[:-1], text])).alias("altered"),
    )


def ranked(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """The rows with their ``rank`` (from 0) within ``group`` in the given order, and the group's ``n`` rows.

    Rows that are equal in ``order`` are told apart by their place in the stored input, so that they
    can be dealt to several partitions too.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()), label)
    placed = cut_lineage(
        stored.repartitionByRange(tasks, group, *order, "_row").sortWithinPartitions(group, *order, "_row")
        .withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()).drop("_row"),
        f"{label}-sorted", "zstd",
    )
    # one row for each source in a partition: at most partitions + sources
    runs = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("n"),
    )
    return placed.join(runs, [group, "_part"]).withColumn("rank", F.col("_at") + F.col("_shift")).drop(
        "_at", "_part", "_shift"
    )


@dataclass(frozen=True)
class Forest:
    """Trees over groups of nodes. ``heights[h]`` holds group, rank, digest of the nodes at height h and the digests of their
    ``children`` (h > 0); ``tops`` holds group, digest and height of each group's last node."""

    heights: list[DataFrame]
    tops: DataFrame


def grow(nodes: DataFrame, label: str) -> Forest:
    """Hashes every 16 consecutive nodes of a group (group, rank, n, digest) until each group has one.

    The number of steps is the logarithm of the largest group; every step is written once.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    heights, tops = [nodes], [nodes.filter("n = 1").select("group", "digest", F.lit(0).alias("height"))]
    while most > 1:
        most = -(-most // FANOUT)
        children = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda x: x.digest)
        level = (
            heights[-1].filter("n > 1")
            .groupBy("group", F.shiftright("rank", BITS).alias("up"))
            .agg(children.alias("children"), F.max(F.ceil(F.col("n") / FANOUT)).alias("n"))
            .select("group", F.col("up").alias("rank"), "n", hashed(F.col("children")).alias("digest"), "children")
        )
        heights.append(cut_lineage(level, f"{label}-{len(heights)}", "zstd"))
        tops.append(heights[-1].filter("n = 1").select("group", "digest", F.lit(len(heights) - 1).alias("height")))
    last = tops[0]
    for t in tops[1:]:
        last = last.union(t)
    return Forest(heights, last)


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (id, altered or NULL, place in the order of sources ``group``, ``rank``, digest), the ``sources`` (src, group,
    subroot) and the two forests. `records` (digest, children) are the manifest's inner nodes."""

    leaves: DataFrame
    sources: DataFrame
    below: Forest
    above: Forest

    def records(self) -> DataFrame:
        """Digest and children of every inner node, equal nodes once."""
        levels = [h.select("digest", "children") for f in (self.below, self.above) for h in f.heights[1:]]
        if not levels:
            empty = "digest binary, children array<binary>"
            return self.leaves.sparkSession.createDataFrame([], empty)
        found = levels[0]
        for level in levels[1:]:
            found = found.union(level)
        return found.dropDuplicates(["digest"])


def build(docs: DataFrame, tampered: Column | None = None) -> Manifest:
    """Hashes all rows of a table (see the module's text) and all levels of the trees."""
    placed = ranked(leaves_of(docs, tampered), "src", ["id", "leaf"], "leaves")
    first = placed.select(F.col("src").alias("group"), "rank", "n", F.col("leaf").alias("digest"), "id", "altered")
    first = cut_lineage(first, "ranked-leaves", "zstd")
    below = grow(first.select("group", "rank", "n", "digest"), "level")
    tops = below.tops.select(
        F.lit(0).alias("group"), F.col("group").alias("src"), F.col("digest"), "height"
    )
    listed = cut_lineage(ranked(tops, "group", ["src"], "subroots"), "sources")
    above = grow(listed.select("group", "rank", "n", "digest"), "upper")
    return Manifest(first, listed.select("src", F.col("rank").alias("place"), "digest", "height"), below, above)


def _taken(children: str, at: Column) -> Column:
    """A step of a path: what lies left and right of the child that is taken."""
    sides = F.slice(F.col(children), F.lit(1), at), F.slice(F.col(children), at + 2, F.size(children))
    return F.struct(joined(sides[0]).alias("left"), joined(sides[1]).alias("right"))


PATH = "array<struct<left:binary,right:binary>>"
FRONT = ["place", "subroot", "root", "rank", "digest", "path"]


def _step(front: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """One step down: the children (place, rank) of the front's nodes that are ``wanted``, with their paths."""
    kids = front.join(records, "digest").select(
        "place", "subroot", "root", "rank", "path", "children", F.posexplode("children").alias("digit", "digest")
    )
    down = kids.select(
        "place", "subroot", "root", (F.col("rank") * FANOUT + F.col("digit")).cast("long").alias("rank"), "digest",
        F.concat("path", F.array(_taken("children", F.col("digit")))).alias("path"),
    )
    return down.join(wanted, ["place", "rank"], "left_semi").select(*FRONT)




def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """The paths of requested leaves: src and rank, children not taken from the root down.

    ``requests`` holds src, rank, leaf and whatever else is to be kept (one row per request); gives its
    columns with subroot, root and ``path``.
    """
    records = cut_lineage(manifest.records(), "records", "zstd")
    asked = requests.join(manifest.sources.select("src", "place", "height"), "src")
    asked = cut_lineage(asked, "requests", "zstd")

    # from the root to the subroots that are asked for
    sources = cut_lineage(asked.select("place", "height").distinct(), "asked-sources")
    top = len(manifest.above.heights) - 1
    front = manifest.above.tops.select(
        F.lit(0).cast("long").alias("place"), F.col("digest").alias("subroot"), F.col("digest").alias("root"),
        F.lit(0).cast("long").alias("rank"), "digest", F.array().cast(PATH).alias("path"),
    )
    for height in reversed(range(top)):
        wanted = sources.select(F.lit(0).cast("long").alias("place"), F.shiftright("place", BITS * height).alias("rank"))
        wanted = wanted.distinct()
        front = cut_lineage(_step(front, records, wanted), f"down-{height}")
    subroots = front.select(F.col("rank").alias("place"), F.col("digest").alias("subroot"), "root", "digest", "path")
    subroots = cut_lineage(subroots.join(sources, "place"), "asked-subroots")

    # below them, all sources of one height or more at once; a source joins when its own height is reached
    below = len(manifest.below.heights) - 1
    front = None
    for height in reversed(range(1, below + 1)):
        enter = subroots.filter(F.col("height") == height).select(
            "place", "subroot", "root", F.lit(0).cast("long").alias("rank"), "digest", "path"
        )
        front = enter if front is None else front.union(enter)
        if height > 1:
            wanted = asked.filter(F.col("height") >= height).select(
                "place", F.shiftright("rank", BITS * (height - 1)).alias("rank")
            ).distinct()
            front = cut_lineage(_step(front, records, wanted), f"down-{height - 1}", "zstd")
    alone = asked.filter("height = 0").join(subroots.select("place", "subroot", "root", "path"), "place")
    columns = [c for c in asked.columns if c not in ("place", "height")]
    alone = alone.select(*columns, "subroot", "root", "path")
    if front is None:
        return alone
    # the last step: sixteen leaves share what their node has
    nodes = front.join(records, "digest").select("place", F.col("rank").alias("_up"), "subroot", "root", "path", "children")
    deep = asked.filter("height > 0").withColumn("_up", F.shiftright("rank", BITS))
    last = deep.join(nodes, ["place", "_up"]).withColumn("_digit", (F.col("rank") % FANOUT).cast("int"))
    return last.select(
        *columns, "subroot", "root", F.concat("path", F.array(_taken("children", F.col("_digit")))).alias("path")
    ).union(alone)


def proof_text(path: str = "path") -> Column:
    """The siblings as one hex text, from the leaf up."""
    ends = F.transform(F.reverse(path), lambda s: F.concat(s.left, s.right))
    return F.lower(F.hex(joined(ends)))


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(
        F.reverse(path), leaf,
        lambda acc, s: F.unhex(F.sha2(F.lower(F.hex(F.concat(s.left, acc, s.right))), 256)),
    )


def verify(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row (digests as hex text).

    All but the last two belong to the table as it is; ``folded_root`` is recomputed from the leaf as it would be
    if the text of ``tampered`` rows were lower-cased, and the original siblings.
    """
    manifest = build(docs, tampered)
    asked = manifest.leaves.select(
        F.col("group").alias("src"), "rank", "id", F.col("digest").alias("leaf"),
        F.coalesce("altered", "digest").alias("given"),
    )
    found = proofs(manifest, asked).withColumn("folded", folded(F.col("given")))
    return found.select(
        F.col("id").alias("doc_id"), hex_of("leaf").alias("leaf"), hex_of("subroot").alias("subroot"),
        hex_of("root").alias("root"), F.sha2(proof_text(), 256).alias("proof_sha256"),
        hex_of("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
