"""Substring deduplication: word windows that a document with a smaller id holds too are removed.

Sparse suffix trees over prefix partitions. Of each window of ``window`` words, the ``SEED``-word
sequence with the least hash (leftmost among equals) is its anchor, so equal windows have equal
anchors at equal places. Only anchors are suffix starts; an anchor serves a run of neighbouring
windows and carries the words of that run (its context). Anchors whose words occur in one text only
are dropped by a partial aggregate before any text moves.

Suffixes are partitioned by a prefix of variable length: ``PREFIXES[0]`` words, and more words where
a prefix has more than ``GROUP`` suffixes. In a partition, suffixes are sorted and the common prefixes of
neighbours give the tree: its internal nodes of depth d are the runs whose neighbours agree in d
words. A second tree, over the words before the anchors, gives the common beginnings. A window that
starts j words before its anchor is the pair of its node of depth ``window - j`` in the one tree and
of depth j in the other; the least document of a pair is the window's first.

Equal contexts are merged with their least document first, so a passage that very many documents
share is one suffix. If a full-length prefix still has more than ``GROUP`` different contexts, its windows are
counted by digest with a partial aggregate instead: exact, and not bound to one task.

Defined cases: NULL is a text without words; texts shorter than a window lose nothing; rows with a
NULL id lose nothing and remove nothing; rows with one id don't remove each other's words, and equal
rows give equal results; an empty table gives no rows; other columns are ignored. Words are compared
by 64-bit hashes within a partition, and contexts by 128-bit digests.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from milepost.llm.common import Words, numbered, steps, text_column, texts_of, utf8
from milepost.operators.skew import one_per_key
from milepost.session import cut_lineage

WINDOW = 50
#: Words of an anchor, the longest prefix of a partition; and the shorter ones.
SEED = 16
PREFIXES = (4, 8, SEED)
#: Suffixes of one partition.
GROUP = 20_000
#: Partition keys that may be sent to all executors (8 bytes each); more are joined.
SENT_KEYS = 50_000
STEP = np.uint64(0x9E3779B97F4A7C15)


def rolled(values: np.ndarray, size: int) -> np.ndarray:
    """Rolling hashes of ``size`` neighbours."""
    out = values
    with np.errstate(over="ignore"):
        for k in range(1, size):
            out = out[:-1] * STEP + values[k:] if len(values) > k else out[:0]
    return out


def leftmost_least(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the leftmost least value in every run of ``span`` neighbours."""
    at, have = np.arange(len(values)), 1
    while have < span:
        step = min(have, span - have)
        a, b = at[:-step], at[step:]
        at = np.where(values[b] < values[a], b, a)
        have += step
    return at


def anchors(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """Text, hash, place and first and last window start of each anchor, as places in the slice."""
    grams = rolled(words.hashes(), SEED)
    if len(words.start) < window:
        return (np.zeros(0, np.int64),) * 5
    least = leftmost_least(grams, window - SEED + 1)
    doc = words.doc()[: len(least)]
    start = np.flatnonzero(np.arange(len(least)) + window <= words.first[1:][doc])
    p, d = least[start], doc[start]
    new = np.append(True, (p[1:] != p[:-1]) | (d[1:] != d[:-1]))[: len(p)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(p)) - 1
    return d[first], grams[p[first]].view(np.int64), p[first], start[first], start[last]


def _scan(window: int):
    def run(batches):
        for batch in steps(batches):
            words = Words(utf8(batch))
            doc, h, *_ = anchors(words, window)
            named = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            doc, h = doc[named[doc]], h[named[doc]]
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            new = np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))[: len(h)]
            doc, h = doc[new], h[new]
            cuts = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
            sha = [hashlib.sha256(j).digest() for j in words.joined]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(words.counts), pa.array(sha, pa.binary()),
                 pa.ListArray.from_arrays(cuts, pa.array(h))],
                ["doc_id", "th", "n_words", "sha", "anchors"],
            )

    return run


def _contexts(window: int):
    """The words around each shared anchor of a text: from its first window's start to its last one's end."""

    def run(batches):
        for batch in steps(batches):
            words = Words(utf8(batch))
            value = words.hashes()
            hashes = {q: rolled(value, q) for q in PREFIXES}
            doc, h, p, s1, s2 = anchors(words, window)
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            shared = np.zeros(len(h), bool)
            for k, found in enumerate(batch.column("found").to_pylist()):
                shared[cut[k] : cut[k + 1]] = np.isin(h[cut[k] : cut[k + 1]], found)
            doc, p, s1, s2 = (x[shared] for x in (doc, p, s1, s2))
            raw, left, wins = words.buf.tobytes(), p - s1, s2 - s1
            parts = [raw[a:b] for a, b in zip(words.start[s1].tolist(), words.end[s2 + window - 1].tolist())]
            keys = [hashlib.md5(b"%d %d\0" % tuple(x) + part).digest() for *x, part in zip(left.tolist(), wins.tolist(), parts)]
            place = (s1 - words.first[doc]).tolist()
            one: dict[tuple[int, bytes], int] = {}  # first occurrence of each context in each text
            pick, starts = [], []
            for k, context in enumerate(zip(doc.tolist(), keys)):
                at = one.setdefault(context, len(pick))
                if at == len(pick):
                    pick.append(k)
                    starts.append([])
                starts[at].append(place[k])
            pick = np.array(pick, np.int64)
            row = pa.array(doc[pick])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(row), batch.column("th").take(row),
                 pa.array(starts, pa.list_(pa.int32())),
                 *(pa.array(x[pick].astype(np.int32)) for x in (left, wins)),
                 pa.array([keys[k] for k in pick], pa.binary()), pa.array([parts[k] for k in pick], pa.binary()),
                 *(pa.array(hashes[q][p[pick]].view(np.int64)) for q in PREFIXES)],
                ["doc_id", "th", "starts", "left", "wins", "ckey", "words", *(f"h{q}" for q in PREFIXES)],
            )

    return run


def _sorted_tree(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows and the number of leading words each has in common with the row before.

    0 pads a row and is no word.
    """
    keys = rows.astype(">u4").tobytes()
    width = 4 * rows.shape[1]
    order = np.array(sorted(range(len(rows)), key=lambda k: keys[k * width : (k + 1) * width]), np.int64)
    own = rows[order]
    differ = np.ones((len(rows), rows.shape[1] + 1), bool)
    differ[1:, :-1] = (own[1:] != own[:-1]) | (own[1:] == 0)
    common = differ.argmax(axis=1)
    common[:1] = -1
    return order, common


def covered_windows(texts: list[bytes], left: np.ndarray, wins: np.ndarray, first: np.ndarray,
                    window: int) -> list[list[int]]:
    """For each context, its windows (from 0) that a smaller document than ``first`` has as well.

    ``left``: words before the anchor; ``wins``: number of windows less one.
    """
    words = Words(texts)
    m, base, size = len(texts), words.first[:-1], words.counts
    ids = np.append(0, np.unique(words.hashes(), return_inverse=True)[1] + 1).astype(np.uint32)
    reach = window - SEED

    def matrix(width: int, at, ok) -> np.ndarray:
        k = np.arange(width)
        place = base[:, None] + at(left[:, None], k)
        good = ok(left[:, None], k)
        return ids[np.where(good, place + 1, 0)]

    right = matrix(window, lambda a, k: a + k, lambda a, k: a + k < size[:, None])
    before = matrix(reach, lambda a, k: a - 1 - k, lambda a, k: k < a)
    r_order, r_common = _sorted_tree(right)
    l_order, l_common = _sorted_tree(before)
    out: list[list[int]] = [[] for _ in range(m)]
    for j in range(reach + 1):  # windows that start j words before the anchor
        has = (j <= left) & (j >= left - wins)
        r_node = np.empty(m, np.int64)
        r_node[r_order] = np.cumsum(r_common < window - j)
        l_node = np.empty(m, np.int64)
        l_node[l_order] = np.cumsum(l_common < j)
        rows = np.flatnonzero(has & (np.bincount(r_node)[r_node] > 1))  # leaves of internal nodes
        if not len(rows):
            continue
        _, node = np.unique(r_node[rows] * (m + 1) + l_node[rows], return_inverse=True)
        least = np.full(node.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, first[rows])
        for k in rows[least[node] < first[rows]].tolist():
            out[k].append(int(left[k]) - j)
    return out


def _trees(window: int):
    schema = ["ckey", "offs"]

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        offs = covered_windows(
            t.column("words").to_pylist(), t.column("left").to_numpy().astype(np.int64),
            t.column("wins").to_numpy().astype(np.int64), t.column("first").to_numpy(), window,
        )
        keep = [k for k, x in enumerate(offs) if x]
        keys = t.column("ckey").to_pylist()
        return pa.RecordBatch.from_arrays(
            [pa.array([keys[k] for k in keep], pa.binary()), pa.array([offs[k] for k in keep], pa.list_(pa.int32()))], schema
        )

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= GROUP:  # sorted by partition: cut where a new one begins
                key = batch.column("pkey").to_numpy()
                change = np.flatnonzero(key != held[-1].column("pkey")[-1].as_py())
                stop = int(change[0]) if len(change) else batch.num_rows
                held.append(batch.slice(0, stop))
                batch = batch.slice(stop)
                rows += stop
                if not batch.num_rows:
                    continue
                yield flush(held)
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if rows:
            yield flush(held)

    return run


def _window_digests(window: int):
    def run(batches):
        for batch in batches:
            words = Words(batch.column("words").to_pylist())
            raw, out = words.buf.tobytes(), {"ckey": [], "first": [], "off": [], "wkey": []}
            for k, (ckey, first, wins) in enumerate(zip(
                batch.column("ckey").to_pylist(), batch.column("first").to_pylist(), batch.column("wins").to_pylist()
            )):
                base = int(words.first[k])
                for off in range(wins + 1):
                    part = raw[words.start[base + off] : words.end[base + off + window - 1]]
                    for c, x in (("ckey", ckey), ("first", first), ("off", off), ("wkey", hashlib.md5(part).digest())):
                        out[c].append(x)
            kinds = {"ckey": pa.binary(), "first": pa.int64(), "off": pa.int32(), "wkey": pa.binary()}
            yield pa.RecordBatch.from_pydict({c: pa.array(x, kinds[c]) for c, x in out.items()})

    return run


def _large(contexts: DataFrame, column: str, group: int) -> DataFrame:
    """Prefixes with more suffixes than a partition may have."""
    found = cut_lineage(
        contexts.groupBy(column).agg(F.count("*").alias("n")).filter(F.col("n") > group)
        .select(F.col(column).alias("pkey"), F.lit(True).alias("large")), "large-prefixes",
    )
    return F.broadcast(found) if found.count() <= SENT_KEYS else found


def repeated_offsets(contexts: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """ckey and offs (array<int>): the windows of each context that occur in a smaller document."""
    last = f"h{PREFIXES[-1]}"
    open_ = contexts.withColumn("pkey", F.col(f"h{PREFIXES[0]}"))
    for q in PREFIXES:  # lengthen the prefix of partitions that are too large
        large = _large(open_ if q == PREFIXES[0] else open_.filter("large"), "pkey", group)
        longer = PREFIXES[min(PREFIXES.index(q) + 1, len(PREFIXES) - 1)]
        open_ = open_.drop("large").join(large, "pkey", "left").withColumn("large", F.coalesce("large", F.lit(False)))
        if q != PREFIXES[-1]:
            open_ = open_.withColumn("pkey", F.when(F.col("large"), F.col(f"h{longer}")).otherwise(F.col("pkey")))
    tasks = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = (
        open_.filter("NOT large").select("pkey", "ckey", "left", "wins", "first", "words")
        .repartition(tasks, "pkey").sortWithinPartitions("pkey")
        .mapInArrow(_trees(window), "ckey binary, offs array<int>")
    )
    windows = cut_lineage(
        open_.filter("large").select("ckey", "first", "wins", "words")
        .mapInArrow(_window_digests(window), "ckey binary, first long, off int, wkey binary"), "hot-windows",
    )
    least = windows.groupBy("wkey").agg(F.min("first").alias("least"))
    hot = (
        windows.join(least, "wkey").filter("least < first")
        .groupBy("ckey").agg(F.collect_list("off").alias("offs"))
    )
    return small.unionByName(hot)


def _apply(window: int, keep_layout: bool):
    def run(batches):
        for batch in steps(batches):
            raw = utf8(batch)
            words = Words(raw)
            out = {"n_words": [], "n_removed": [], "sha": [], "text": []}
            for k, (text, runs) in enumerate(zip(raw, batch.column("runs").to_pylist())):
                n = int(words.counts[k])
                edge = np.zeros(n + 1, np.int64)
                for r in runs:
                    edge[r["a"]] += 1
                    edge[r["b"] + window] -= 1
                gone = np.cumsum(edge)[:n] > 0
                own = words.joined[k].split(b" ") if n else []
                kept = b" ".join([w for w, g in zip(own, gone.tolist()) if not g])
                out["n_words"].append(n)
                out["n_removed"].append(int(gone.sum()))
                out["sha"].append(hashlib.sha256(kept).digest())
                out["text"].append((_cut(text, own, gone) if keep_layout else kept).decode())
            kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "sha": pa.binary(), "text": pa.string()}
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "th": batch.column("th")}
                | {c: pa.array(x, kinds[c]) for c, x in out.items()}
            )

    return run


def _cut(text: bytes, words: list[bytes], gone: np.ndarray) -> bytes:
    """The text without the words that are gone and the white space after each of them."""
    at, ends = 0, []
    for w in words:
        at = text.index(w, at)
        ends.append(at)
        at += len(w)
    ends.append(len(text))
    parts = [text[: ends[0]]]
    parts += [text[a:b] for a, b, g in zip(ends, ends[1:], gone.tolist()) if not g]
    return b"".join(parts)


def _copies(rows: DataFrame, window: int) -> DataFrame:
    """doc_id, th of the rows whose whole text a row with a smaller id has.

    The firsts are reduced so that the join on a large group of copies can be split (`operators.skew`), and
    the result is to be written before it is joined again.
    """
    firsts = one_per_key(
        rows.filter(F.col("n_words") >= window), ["sha"], F.min("doc_id").alias("one"), F.count("*").alias("n")
    ).filter("n > 1").drop("n")
    return rows.select("doc_id", "th", "sha").join(firsts, "sha").filter("doc_id > one").select("doc_id", "th")


def _runs(members: DataFrame, contexts: DataFrame, offs: DataFrame) -> DataFrame:
    """doc_id, th, runs: places of repeated windows, from what is known of the context.

    One side comes out of a join on the context itself. That join takes a hash of the context as a second key, so
    that the other one has exchanges of its own on both sides and a context of very many documents can be
    split. The result is to be written before it is grouped.
    """
    spread = F.xxhash64("ckey").alias("_spread")
    known = contexts.select("ckey", "first", spread).join(
        offs.select("ckey", "offs", spread), ["_spread", "ckey"], "left"
    ).drop("_spread")
    runs = F.expr(
        "CASE WHEN doc_id > first THEN transform(starts, s -> struct(s AS a, s + wins AS b))"
        " ELSE flatten(transform(starts, s -> transform(coalesce(offs, array()),"
        " o -> struct(s + o AS a, s + o AS b)))) END"
    )
    return (
        members.select("doc_id", "th", "starts", "wins", "ckey").join(known, "ckey")
        .select("doc_id", "th", runs.alias("runs")).filter("size(runs) > 0")
    )


def dedup_substrings(docs: DataFrame, window: int = WINDOW, group: int = GROUP, keep_layout: bool = False,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th (hash of the text), n_words, n_removed, kept_sha256, text of every row.

    ``text`` is NULL where nothing goes, otherwise what is left: the kept words joined by one space or, with ``keep_layout``, with their own
    white space. The digest is always of the kept words joined by one space.
    """
    if window < SEED + 1:
        raise ValueError(f"window must be longer than {SEED} words")
    base = texts_of(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    rows = cut_lineage(
        base.mapInArrow(_scan(window), "doc_id long, th long, n_words long, sha binary, anchors array<long>"), "anchors"
    )
    # equal texts: all but the first document's lose every word
    same = F.xxhash64("sha")
    copies = cut_lineage(_copies(rows, window), "copies")
    found = rows.select("doc_id", "th", same.alias("seq"), F.explode("anchors").alias("h"))
    shared = found.groupBy("h").agg(F.min("seq").alias("x"), F.max("seq").alias("y")).filter("x <> y").select("h")
    marked = (
        found.drop("seq").join(shared, "h", "left_semi").groupBy("doc_id", "th")
        .agg(F.collect_set("h").alias("found"))
        .join(copies, ["doc_id", "th"], "left_anti")
    )
    touched = cut_lineage(base.join(marked, ["doc_id", "th"]), "touched", compression="zstd")
    members = cut_lineage(
        touched.mapInArrow(
            _contexts(window),
            "doc_id long, th long, starts array<int>, left int, wins int, ckey binary, words binary,"
            " h4 long, h8 long, h16 long",
        ), "contexts", compression="zstd",
    )
    contexts = cut_lineage(
        members.groupBy("ckey", "h4", "h8", "h16", "left", "wins", "words").agg(F.min("doc_id").alias("first")), "suffixes",
        compression="zstd",
    )
    offs = repeated_offsets(contexts, window, group)
    found = cut_lineage(_runs(members, contexts, offs), "runs")  # written before it is grouped, see there
    spans = found.groupBy("doc_id", "th").agg(F.array_distinct(F.flatten(F.collect_list("runs"))).alias("runs"))
    cut = cut_lineage(
        touched.select("doc_id", "th", "text").join(spans, ["doc_id", "th"]).mapInArrow(
            _apply(window, keep_layout),
            "doc_id long, th long, n_words long, n_removed long, sha binary, text string",
        ), "cut-texts",
    )
    changed = cut.select("doc_id", "th", F.lit(False).alias("whole"), "n_removed", "sha", "text").dropDuplicates(
        ["doc_id", "th"]
    ).unionByName(copies.distinct().withColumn("whole", F.lit(True)), allowMissingColumns=True)
    changed = changed.withColumnRenamed("sha", "kept")
    nothing = F.lit(bytearray(hashlib.sha256(b"").digest()))
    return (
        rows.select("doc_id", "th", "n_words", "sha").join(changed, ["doc_id", "th"], "left")
        .select(
            "doc_id", "th", "n_words",
            F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.lower(F.hex(F.when(F.col("whole"), nothing).otherwise(F.coalesce("kept", "sha")))).alias("kept_sha256"),
            F.when(F.col("whole"), F.lit("")).otherwise(F.col("text")).alias("text"),
        )
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All rows of ``docs`` with what is left of their texts (and ``n_chars``, if there), all columns."""
    found = dedup_substrings(docs, window, keep_layout=True).filter("text IS NOT NULL")
    left = found.select(F.col("doc_id").alias("k1"), F.col("th").alias("k2"), F.col("text").alias("k3")).dropDuplicates(["k1", "k2"])
    named, at = numbered(docs)
    own = named.withColumn("k1", F.col(at["doc_id"]).cast("long")).withColumn("k2", F.xxhash64(text_column(at["text"])))
    new = {at["text"]: F.coalesce("k3", at["text"])}
    if "n_chars" in at:
        new[at["n_chars"]] = F.when(F.col("k3").isNotNull(), F.length("k3").cast("long")).otherwise(F.col(at["n_chars"]))
    joined = own.join(left, ["k1", "k2"], "left")
    return joined.select(*(new.get(c, F.col(c)) for c in named.columns)).toDF(*docs.columns)
