"""Quality model, URL filter, multi-index, packing, pipeline."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from milepost.llm import common, multi_index, packing, quality_gam, queries, repetition_rules, url_filter
from tests.llm.conftest import EDGE, rows_of
from tests.llm.test_duplicates import want_components, want_removed
from tests.llm.test_texts import WORDS, documents


# quality model

def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_edges(spark, edge, nothing):
    labels = labels_frame(spark, [(d, k % 2, 0) for k, (d, *_) in enumerate(EDGE)] + [(1, None, 0), (None, 1, 0), (999, 1, 1)])
    got = quality_gam.classify(edge, labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert len({r.score for r in got if r.doc_id == 10}) == 1
    assert quality_gam.classify(nothing, labels).count() == 0
    empty = labels.limit(0)
    assert {r.score for r in quality_gam.classify(edge, empty).collect()} == {0.5}


def test_labels_and_ids_do_not_enter_scores(spark, make_docs):
    text = [(k, f"word{k} " * (k + 1)) for k in range(40)]
    labels = labels_frame(spark, [(k, int(k > 20), 0) for k in range(40)])
    a = quality_gam.train(make_docs(text), labels)
    rows = quality_gam.measures([t for _, t in text], [t.encode() for _, t in text])
    assert (a.score(rows) == a.score(rows.copy())).all() and rows.shape[1] == len(quality_gam.MEASURES)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op3_quality_gam(spark, sf).filter("held_out").join(labels, "doc_id")
    right, n, clean, kept = got.select(
        F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*"),
        F.sum("quality"), F.sum(F.col("quality") * F.col("predicted")),
    ).first()
    assert right >= 0.95 * n and kept >= 0.97 * clean


def test_pairs_are_learned():
    r = np.random.default_rng(1)
    x = r.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y)
    test = r.random((1000, 4))
    want = (test[:, 0] > 0.5) ^ (test[:, 1] > 0.5)
    assert ((model.score(test) >= 0.5) == want).mean() > 0.9
    assert (0, 1) in [p[:2] for p in model.pairs]


# URL filter

URLS = [
    "http://Example.ORG/es/x?y#z", "https://www.example.org/en/12", "https://example.org/en/2", "http://a.b.com/fr/1",
    "http://b.com/de/", "http://com/de/x", "http://notexample.org/es/1", "http://org", "http://org?x=/a", "x://y://z/p",
    None, "", "no scheme", "://", "http://a.net/p#q?r", "HTTP://ÄÖ.Com/fr/é", "ftp://u.example.org/en/1", "http://b.com/de",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = next((rest[:k] for k, c in enumerate(rest) if c in "/?#"), rest)
    tail = rest[len(host) :]
    path = next((tail[:k] for k, c in enumerate(tail) if c in "?#"), tail)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_for(host, path):
    fit = [(v, h + p) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fit, key=lambda r: (-len(r[1]), r[1]), default=(None, None))


def test_url_edges(spark):
    urls = spark.createDataFrame([(k, u, "x", 1.0) for k, u in enumerate(URLS)], "page_id long, url string, rule string, score double")
    got = {r.page_id: r for r in url_filter.judge(urls, queries.URL_RULES, [0.0] * url_filter.BUCKETS, -1.0).collect()}
    assert len(got) == len(URLS)
    for k, u in enumerate(URLS):
        verdict, rule = rule_for(*parts(u))
        assert (got[k].host, got[k].path, got[k].rule) == (*parts(u), rule), u
        assert got[k].verdict == (verdict or "block")
    assert url_filter.judge(urls.limit(0), queries.URL_RULES, *url_filter.fit(urls.limit(0).selectExpr("'' host", "'' path", "1 label"))).count() == 0


def test_url_model_learns(spark):
    r = random.Random(6)
    rows = [(f"{'shop' if k % 2 else 'news'}{r.randrange(999)}.net", f"/{r.randrange(999)}", k % 2) for k in range(400)]
    frame = spark.createDataFrame(rows, "host string, path string, label int")
    weights, bias = url_filter.fit(frame.limit(300))
    got = frame.withColumn("grams", url_filter.features()).withColumn("p", url_filter.score(weights, bias))
    assert got.filter((F.col("p") >= 0.5).cast("int") == F.col("label")).count() >= 390


def test_op5(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = queries.op5_url_filter(spark, sf_dir).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        host, path = parts(pages[r.page_id])
        verdict, rule = rule_for(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_op5_runs_without_python(spark, sf_dir):
    plan = queries.op5_url_filter(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# multi-index

def nearest(rows, queries_, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in queries_:
        v = np.array(v, float)
        scored = sorted((-(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), i) for i, w in ok if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, 3, 0.5) for i, v in rows], "vec_id long, embedding array<float>, cell int, score double")


def test_index_edges(spark):
    r = random.Random(8)
    rows = [(k, [r.gauss(0, 1) for _ in range(6)]) for k in range(90)]
    rows += [(100 + k, [1.0, 2.0, 0.0, 0.0, 1.0, -1.0]) for k in range(30)]
    odd = [(200, None), (201, [0.0] * 6), (202, [1.0, None] + [0.0] * 4), (203, [float("nan")] + [1.0] * 5),
           (204, [float("inf")] + [1.0] * 5), (205, [1.0]), (None, [1.0] * 6), (250, []), (206, [])]
    frame = vectors_frame(spark, rows + odd)
    got = multi_index.nearest_neighbours(frame, frame.filter("vec_id % 10 = 0"), k=5, centroids=4).collect()
    f32 = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    want = nearest(f32, [(i, v) for i, v in f32 if i % 10 == 0], 5)
    assert {g.query_id for g in got} == set(want)
    for q, best in want.items():
        own = sorted((g.rank, g.vec_id, g.score) for g in got if g.query_id == q)
        assert [x[0] for x in own] == [1, 2, 3, 4, 5]
        assert [x[1] for x in own] == [i for i, _ in best]
        assert np.allclose([x[2] for x in own], [s for _, s in best], atol=1e-12)
    few = vectors_frame(spark, rows[:3])
    assert multi_index.nearest_neighbours(few, few, k=5).count() == 6
    assert multi_index.nearest_neighbours(few.limit(0), few.limit(0)).count() == 0
    bad = vectors_frame(spark, odd)
    assert multi_index.nearest_neighbours(bad.filter("vec_id = 201"), bad).count() == 0


@pytest.mark.parametrize("block", [16, 2048])
def test_blocks_lose_nothing(spark, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "QUERIES", 4)
    rows = [(k, [float(k % 3), 1.0, 0.5, float(k % 2)]) for k in range(200)]
    frame = vectors_frame(spark, rows)
    got = multi_index.nearest_neighbours(frame, frame.filter("vec_id % 20 = 0"), k=3, share=1.0)
    want = nearest(rows, [(i, v) for i, v in rows if i % 20 == 0], 3)
    assert {(r.query_id, r.rank): r.vec_id for r in got.collect()} == {(q, n + 1): i for q, b in want.items() for n, (i, _) in enumerate(b)}


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    got = {(r.query_id, r.vec_id) for r in queries.op9_multi_index(spark, sf).collect()}
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    v = multi_index.unit(np.array(t.embedding.tolist(), float))
    ids = t.vec_id.to_numpy()
    q = np.flatnonzero(ids % 50 == 0)
    s = v[q] @ v.T
    s[np.arange(len(q)), q] = -9
    want = {(int(ids[a]), int(ids[b])) for a, row in zip(q, np.argsort(-s, axis=1)[:, :5]) for b in row}
    assert len(got & want) >= 0.9 * len(want)


# packing

def test_tightest_compatible_bin():
    r = random.Random(9)
    for case in range(30):
        n = r.randrange(1, 120)
        items = sorted(((r.randrange(0, 101), r.choice([1, 1, 1, 2, 3, 4, None]), r.randrange(1 + case * 3)) for _ in range(n)), key=lambda x: -x[0])
        has = np.array([s is not None for _, s, _ in items])
        source = np.array([s or 0 for _, s, _ in items])
        bins, place = packing.pack_shard(np.array([x[0] for x in items]), source, has, np.array([x[2] for x in items]), 100)
        for b in set(bins.tolist()):
            own = [k for k in range(n) if bins[k] == b]
            assert sum(items[k][0] for k in own) <= 100
            known = [items[k][1] for k in own if has[k]]
            assert len(known) == len(set(known)) and len({items[k][2] for k in own}) == len(own)
            at = 0
            for k in own:
                assert place[k] == at
                at += items[k][0]
        # room left after each step is the least possible, given the bins so far
        state = {}
        for (length, s, c), b in zip(items, bins.tolist()):
            rooms = [100 - u - length for u, ss, cc in state.values() if u + length <= 100 and (s is None or s not in ss) and c not in cc]
            used, ss, cc = state.get(b, (0, frozenset(), frozenset()))
            assert (100 - used - length == min(rooms)) if rooms else b not in state
            state[b] = (used + length, ss | {s}, cc | {c})


def check_packed(got, docs, capacity=4096):
    library = Tokenizer.from_file(WORDS)
    lengths = sorted(((d, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in docs), key=repr)
    got = got.collect()
    bins = {}
    for g in got:
        assert 0 <= g.n_tokens <= capacity and g.first_token == g.piece * capacity
        bins.setdefault(g.bin_id, []).append(g)
    for own in bins.values():
        at = 0
        for g in sorted(own, key=lambda g: (g.place, g.n_tokens)):
            assert g.place == at
            at += g.n_tokens
        assert at <= capacity
    total = {}
    for g in got:
        total[g.doc_id] = total.get(g.doc_id, 0) + g.n_tokens
    want = {}
    for d, n in lengths:
        want[d] = want.get(d, 0) + n
    assert total == want
    return bins


def test_packing_edges(edge, nothing):
    check_packed(packing.pack_documents(edge, WORDS), EDGE)
    assert packing.pack_documents(nothing, WORDS).count() == 0


def test_few_tasks_pack_alike(spark, monkeypatch):
    """Shards are packed by themselves, whichever task they are dealt to."""
    monkeypatch.setattr(packing, "SHARD", 32)
    items = spark.range(300).selectExpr("id AS doc_id", "id % 7 AS source", "1 + id * id % 150 AS n_tokens", "id % 90 AS cluster")
    few = packing.pack(items, 100, tasks=2)
    assert few.rdd.getNumPartitions() == 2
    names = ("doc_id", "piece", "bin_id", "place")
    assert rows_of(few, *names) == rows_of(packing.pack(items, 100), *names)
    assert few.select((F.col("bin_id") / 2**32).cast("long")).distinct().count() > 2


def test_op10(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    bins = check_packed(queries.op10_best_fit_packing(spark, sf_dir), [(r.doc_id, r.text) for r in docs])
    source = {r.doc_id: r.source for r in docs}
    for own in bins.values():
        known = [source[g.doc_id] for g in own if source[g.doc_id] is not None]
        assert len(known) == len(set(known))


# pipeline

def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = common.table(spark, sf_dir, "documents")
    columns = docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in repetition_rules.repetition_measures(docs).filter("kept").collect()}
    want = [x for x in rows if x[0] in kept]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            got = sorted((r.doc_id, r.text) for r in out.collect())
        if k == 0:
            assert got == sorted(want)
        elif k == 1:
            model = quality_gam.train(docs, common.table(spark, sf_dir, "labels"))
            texts = [t or "" for _, t in want]
            score = model.score(quality_gam.measures(texts, [t.encode() for t in texts]))
            want = [x for x, s in zip(want, score) if s >= 0.5]
            assert got == sorted(want)
        elif k == 2:
            stay = {c[2] for c in want_components(want)}
            want = [x for x in want if x[0] in stay]
            assert got == sorted(want)
        elif k == 3:
            removed = {d: n for d, _, n, _ in want_removed(want)}
            assert [d for d, _ in got] == sorted(d for d, _ in want)
            before = dict(want)
            for d, t in got:
                assert len((before[d] or "").split()) - len((t or "").split()) == removed[d]
                assert removed[d] or t == before[d]
            want = got
        else:
            check_packed(out, want)
        docs = out


def test_pipeline_on_edges(spark, edge, nothing, tmp_path, sf_dir):
    for tag, docs in (("edge", edge), ("nothing", nothing)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{tag}{k}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)


def test_run(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "piece", "first_token", "n_tokens", "bin_id", "place"] and got.count() > 0


def test_entry_lists_the_queries():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(queries.QUERIES) < set(names) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES]
