"""SimHash components and substring removal against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from milepost.llm import components, queries, simhash, substring_dedup
from tests.llm.conftest import EDGE, PASSAGE, rows_of
from tests.llm.test_texts import WORD, documents


# SimHash

def fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def labels_of(rows, radius=2):
    """Ids and fingerprints, and a component number for each row."""
    rows = [(d, fingerprint(t)) for d, t, *_ in rows]
    prints = np.array([f for _, f in rows], np.uint64)
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= radius) for p in prints]
    label = np.arange(len(rows))
    while True:
        new = np.array([label[n].min() for n in near])
        new = new[new]
        if (new == label).all():
            break
        label = new
    return rows, label


def want_components(rows, radius=2):
    rows, label = labels_of(rows, radius)
    least = {}
    for k, (d, _) in zip(label, rows):
        if d is not None:
            least[k] = min(d, least.get(k, d))
    return sorted(((d, f"{f:016x}", least.get(k)) for k, (d, f) in zip(label, rows)), key=repr)


def got_components(df):
    return rows_of(df.select("doc_id", simhash.hex_of().alias("f"), "component_id"), "doc_id", "f", "component_id")


def test_simhash_edges(edge, nothing):
    assert got_components(simhash.near_duplicates(edge)) == want_components(EDGE)
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.drop_near_duplicates(nothing).count() == 0


def test_one_of_each_group_stays(edge):
    left = simhash.drop_near_duplicates(edge)
    assert left.columns == edge.columns and left.exceptAll(edge).count() == 0
    assert left.count() == len(set(labels_of(EDGE)[1]))
    assert {r.doc_id for r in left.collect()} == {c[2] for c in want_components(EDGE)}


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_planes(radius):
    r = random.Random(radius)
    values = np.unique(np.array([r.getrandbits(8) * 0x0101010101010101 ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64))
                                 for _ in range(400)], np.uint64))
    planes = simhash.Planes(values)
    for v in values[::17]:
        want = np.flatnonzero(np.bitwise_count(values ^ v) <= radius)
        assert planes.within(int(v), radius, planes.open).tolist() == want.tolist()


def test_links_in_large_keys(spark, monkeypatch):
    """Keys dealt out to parts lose no link."""
    monkeypatch.setattr(simhash, "GROUP", 50)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(3)]
    prints = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randrange(5))) for b in base for _ in range(300)})
    values = np.array(prints, np.uint64)
    classes = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "fingerprint long")
    links = {(a, b) for a, b in simhash.near_links(classes, 2).collect()}
    parent = {int(x): int(x) for x in values.view(np.int64)}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        assert np.bitwise_count(np.uint64(a & (1 << 64) - 1) ^ np.uint64(b & (1 << 64) - 1)) <= 2
        parent[root(a)] = root(b)
    signed = values.view(np.int64)
    for k, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= 2):
            assert root(int(signed[k])) == root(int(signed[j]))


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (201, 200), (200, 201)]
    got = components.connected_components(spark.createDataFrame(edges, "x long, y long"))
    want = {k: 0 for k in range(61)} | {100 + k: 100 for k in range(40)} | {200: 200, 201: 200}
    assert {r.node: r.root for r in got.collect()} == want and got.count() == len(want)
    assert components.connected_components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_op6(spark, sf_dir):
    got = rows_of(queries.op6_simhash(spark, sf_dir), "doc_id", "fingerprint", "component_id")
    assert got == want_components(documents(spark, sf_dir))


# substrings

def want_removed(rows, window=50):
    words = [(d, WORD.findall(t or "")) for d, t, *_ in rows]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in words:
        gone = set()
        if d is not None:
            for i in range(len(w) - window + 1):
                if first[tuple(w[i : i + window])] < d:
                    gone.update(range(i, i + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


REMOVED = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_substring_edges(edge, nothing):
    assert rows_of(substring_dedup.dedup_substrings(edge), *REMOVED) == want_removed(EDGE)
    assert substring_dedup.dedup_substrings(nothing).count() == 0
    assert substring_dedup.without_repeats(nothing).count() == 0


@pytest.mark.parametrize("group", [1, 5, 20_000])
def test_random_repeats(make_docs, group):
    """Passages at random places, runs of one word, few words; also with the smallest partitions."""
    r = random.Random(group)
    passages = [" ".join(r.choice("abcde") for _ in range(r.randrange(50, 120))) for _ in range(6)]
    rows = []
    for d in range(60):
        parts = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(40)))]
        for _ in range(r.randrange(4)):
            p = r.choice(passages).split()
            cut = r.randrange(20)
            parts += [" ".join(p[cut:]), " ".join(r.choice("xyz") for _ in range(r.randrange(6)))]
        if d % 9 == 0:
            parts.append("run " * r.randrange(40, 90))
        rows.append((d // 2 if d % 10 == 0 else d, "\n".join(parts)))
    got = substring_dedup.dedup_substrings(make_docs(rows), group=group)
    assert rows_of(got, *REMOVED) == want_removed(rows)


def test_layout_is_kept(make_docs):
    docs = make_docs([(1, PASSAGE), (2, f"Before,\n{PASSAGE}  after\tit\n"), (3, "not  touched\n"), (4, None)])
    got = {r.doc_id: r for r in substring_dedup.without_repeats(docs).collect()}
    assert got[1].text == PASSAGE and got[2].text == "Before,\nafter\tit\n" and got[2].n_chars == 17
    assert got[3].text == "not  touched\n" and got[4].text is None and len(got) == 4


def test_op2(spark, sf_dir):
    got = rows_of(queries.op2_substring_dedup(spark, sf_dir), *REMOVED)
    want = want_removed(documents(spark, sf_dir))
    assert got == want and sum(w[2] for w in want) > 0


# joins on a context or a text that a third of all rows have

@pytest.fixture
def split_early(spark):
    tiny = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "12",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in tiny}
    for k, v in tiny.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def ran(df):
    """Rows of a DataFrame, and the plan as it ran."""
    total = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")))
    rows = total.collect()[0].n
    return rows, total._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def hot_rows(spark, path):
    """30,000 documents, each third of them with key 7, the others with one of 2,000."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000)
    spark.range(30_000, numPartitions=16).select(
        F.col("id").alias("doc_id"), F.xxhash64("id").alias("th"), F.sha2(key.cast("string"), 256).cast("binary").alias("sha"),
        F.lit(60).cast("long").alias("n_words"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_join_on_copies_is_split(split_early, tmp_path):
    rows = hot_rows(split_early, str(tmp_path / "rows"))
    n, plan = ran(substring_dedup._copies(rows, 50))
    assert "skew=true" in plan and n == 30_000 - rows.select("sha").distinct().count()
    assert substring_dedup._copies(rows, 61).count() == 0


def test_join_on_contexts_is_split(split_early, tmp_path):
    rows = hot_rows(split_early, str(tmp_path / "rows")).withColumnRenamed("sha", "ckey")
    members = rows.withColumns({"starts": F.array(F.lit(3), F.lit(90)), "wins": F.lit(5)})
    contexts = members.groupBy("ckey").agg(F.min("doc_id").alias("first"))
    contexts.write.parquet(str(tmp_path / "contexts"))
    contexts = split_early.read.parquet(str(tmp_path / "contexts"))
    offs = contexts.filter("first % 2 = 0").select("ckey", F.array(F.lit(1), F.lit(4)).alias("offs"))
    found = substring_dedup._runs(members, contexts, offs)
    n, plan = ran(found)
    with_offs = offs.count()
    assert "skew=true" in plan and n == 30_000 - contexts.count() + with_offs
    firsts = [r.first for r in contexts.collect()]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in found.filter(F.col("doc_id").isin(firsts + [29_999])).collect()}
    want = {d: [(4, 4), (7, 7), (91, 91), (94, 94)] for d in firsts if d % 2 == 0}
    assert got == want | {29_999: [(3, 8), (90, 95)]}
