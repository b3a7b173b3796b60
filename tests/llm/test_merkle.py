"""Merkle manifests against a brute-force tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from milepost.llm import merkle, queries
from tests.llm.conftest import EDGE, rows_of
from testbed import check

COLUMNS = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[k : k + 16]) for k in range(0, len(last), 16)])
    return levels


def siblings(levels, k):
    for level in levels[:-1]:
        first = k // 16 * 16
        yield level[first:k], level[k + 1 : first + 16]
        k //= 16


def hit(row):
    return row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0


def want(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([k[2] for k, _ in sorted(by[s], key=lambda x: x[0])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for j, s in enumerate(order):
        for k, (key, r) in enumerate(sorted(by[s], key=lambda x: x[0])):
            path = [*siblings(trees[s], k), *siblings(top, j)]
            text = r["text"]
            if hit(r) and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            acc = leaf(r, text)
            for a, b in path:
                acc = sha(*a, acc, *b)
            proof = sha(*(d for a, b in path for d in a + b))
            out.append((r["doc_id"], key[2], trees[s][-1][0], top[-1][0], proof, acc, acc == top[-1][0]))
    return sorted(out, key=repr)


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def check_frame(docs):
    rows = [r.asDict() for r in docs.collect()]
    got = rows_of(merkle.verify(docs, tampered()), *COLUMNS)
    assert got == want(rows)
    return got


def test_edges(edge, nothing):
    """NULL ids and texts, ids that are used several times, extra columns."""
    assert len(check_frame(edge)) == len(EDGE)
    assert merkle.verify(nothing, tampered()).count() == 0
    assert merkle.build(nothing).records().count() == 0


@pytest.mark.parametrize("sizes", [[1], [17], [16, 1, 2], [1] * 18, [273, 3]])
def test_shapes(spark, make_docs, sizes):
    """Lone leaves, runs of one, more sources than a run, three levels; sources of any order, one NULL."""
    names = [None, "Z", "a", "é", "", "aa"] + [f"s{k}" for k in range(20)]
    rows = [(100 * k + i if k else i, f"Text {i % 7}", names[k]) for k, n in enumerate(sizes) for i in range(n)]
    got = check_frame(make_docs(rows))
    assert any(not g[-1] for g in got) or len(got) < 10


def test_equal_rows_are_leaves_of_their_own(make_docs):
    got = check_frame(make_docs([(7, "Same", "s")] * 40 + [(8, "Same", "s")]))
    assert len(got) == 41


def test_some_requests(spark, make_docs):
    """A few leaves of a manifest, by their places; the others are not looked up."""
    docs = make_docs([(k, f"Text {k}", f"s{k % 3}") for k in range(200)])
    full = {r.doc_id: r for r in merkle.verify(docs).collect()}
    manifest = merkle.build(docs)
    asked = manifest.leaves.filter("id IN (0, 5, 77, 199)").select(
        F.col("group").alias("src"), "rank", "id", F.col("digest").alias("leaf")
    )
    got = merkle.proofs(manifest, asked).select(
        "id", F.sha2(merkle.proof_text(), 256).alias("proof"), (merkle.folded(F.col("leaf")) == F.col("root")).alias("ok")
    ).collect()
    assert sorted((r.id, r.proof) for r in got) == sorted((k, full[k].proof_sha256) for k in (0, 5, 77, 199))
    assert all(r.ok for r in got)


def test_records_hold_every_inner_node_once(make_docs):
    docs = make_docs([(k, f"Text {k}", "s") for k in range(300)])
    records = {bytes(r.digest).hex(): [bytes(c).hex() for c in r.children] for r in merkle.build(docs).records().collect()}
    root = merkle.verify(docs).first().root
    leaves, open_ = 0, [root]
    while open_:
        node = open_.pop()
        if node in records:
            assert sha(*records[node]) == node
            open_ += records[node]
        else:
            leaves += 1
    assert leaves == 300 and len(records) == 19 + 2 + 1


def test_op13(spark, sf_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    df = queries.op13_merkle_manifest(spark, sf_dir)
    got = rows_of(df, *COLUMNS)
    assert got == want(docs)
    con = check.connect(sf_dir)
    found = con.execute(queries.ORACLES["op13_merkle_manifest"])
    names = [d[0] for d in found.description]
    assert check.compare((list(COLUMNS), got), (names, found.fetchall())) == ""
