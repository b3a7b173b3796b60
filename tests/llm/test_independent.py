"""Results of models worked out a second time, without the operators' own scoring."""

import bisect
import math

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from milepost.llm import common, quality_gam, queries, simhash, url_filter
from tests.llm.test_similar import components_of


def test_quality_scores_by_hand(spark, sf_dir):
    """Tables looked up one by one with the standard library's bisection."""
    docs = common.table(spark, sf_dir, "documents")
    model = quality_gam.train(docs, common.table(spark, sf_dir, "labels"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.op3_quality_gam(spark, sf_dir).collect():
        text = texts[r.doc_id]
        row = quality_gam.measures([text], [text.encode()])[0].tolist()
        total = model.base
        for k, (edges, table) in enumerate(zip(model.edges, model.tables)):
            total += table[bisect.bisect_right(edges.tolist(), row[k])]
        for a, b, table in model.pairs:
            at = [bisect.bisect_right(model.coarse[k].tolist(), row[k]) for k in (a, b)]
            total += table[at[0], at[1]]
        assert math.isclose(r.score, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
        assert r.predicted == (r.score >= 0.5)


def test_url_verdicts_by_hand(spark, sf_dir):
    """Where no rule fits: n-grams, buckets and the sum of weights in plain Python."""
    pages = common.table(spark, sf_dir, "pages")
    verdict = url_filter.by_rule(queries.URL_RULES, 0)
    labelled = url_filter.with_parts(pages.select("url")).select(
        "host", "path", F.when(verdict == "allow", 1).when(verdict == "block", 0).alias("label")
    )
    weights, bias = url_filter.fit(labelled)
    free = [r for r in queries.op5_url_filter(spark, sf_dir).collect() if r.rule is None]
    assert {r.verdict for r in free} == {"allow", "block"}
    for r in free:
        text = f"^{r.host}|{r.path}$"
        grams = {text[i : i + n] for n in url_filter.SIZES for i in range(len(text) - n + 1)}
        buckets = {np.int64(np.uint64(xxhash.xxh64(g.encode(), seed=42).intdigest()).view(np.int64)) % url_filter.BUCKETS for g in grams}
        total = bias + sum(weights[b] for b in buckets) / math.sqrt(max(1, len(buckets)))
        if abs(total) > 1e-9:
            assert r.verdict == ("allow" if total > 0 else "block")


def test_packed_clusters(spark, sf_dir):
    """No sequence of the query holds two documents of one component, by a comparison of all documents."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    component = {d: k for (d, _), k in zip(rows, components_of(rows))}
    bins = {}
    for g in queries.op10_best_fit_packing(spark, sf_dir).collect():
        if g.n_tokens < 4096:
            bins.setdefault(g.bin_id, []).append(component[g.doc_id])
    assert max(map(len, bins.values())) > 1
    assert all(len(own) == len(set(own)) for own in bins.values())


@pytest.mark.parametrize("groups", [[1, 2, 63, 64, 65, 130], [2] * 40 + [1] * 9, [63, 63]])
def test_bit_planes_of_many_groups(groups):
    """All groups of a batch side by side, against a comparison of every pair."""
    r = np.random.default_rng(len(groups))
    keys = np.repeat(np.arange(len(groups)), groups)
    base = r.integers(0, 1 << 63, len(groups), dtype=np.uint64)
    flips = np.zeros(len(keys), np.uint64)
    for _ in range(3):
        flips ^= np.uint64(1) << r.integers(0, 64, len(keys), dtype=np.uint64) * (r.random(len(keys)) < 0.6).astype(np.uint64)
    values = base[keys] ^ flips
    a, b = simhash.links_in(np.column_stack([keys, keys, keys]), values, 2)
    assert (np.bitwise_count(a ^ b) <= 2).all()

    def classes(pairs, nodes):
        label = {n: n for n in nodes}

        def root(n):
            while label[n] != n:
                n = label[n]
            return n

        for x, y in pairs:
            label[root(x)] = root(y)
        return {frozenset(n for n in nodes if root(n) == k) for k in {root(n) for n in nodes}}

    found = list(zip(a.tolist(), b.tolist()))
    for k in range(len(groups)):
        nodes = set(values[keys == k].tolist())
        pairs = [(x, y) for x in nodes for y in nodes if x < y and (x ^ y).bit_count() <= 2]
        mine = [(x, y) for x, y in found if x in nodes and y in nodes]
        assert classes(mine, nodes) == classes(pairs, nodes)
