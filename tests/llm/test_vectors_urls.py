"""Operators on vectors, links and URLs against brute force, and the queries' own SQL."""

import math
import random

import numpy as np
import pytest
from against_sql import difference

from joinwright.llm import covertree, queries, topk, urls
from joinwright.llm.components import components
from joinwright.llm.urls import Rule
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, row long, score int, weight int, rank string"


def vectors(spark, rows):
    """Vectors with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA)


def awkward(seed):
    """Clusters, copies, ties, nulls, zeros, odd lengths, repeated ids and a hot label."""
    rnd = np.random.default_rng(seed)
    rows = []
    for c in range(12):
        centre = rnd.normal(size=8)
        for _ in range(14):
            x = (centre + rnd.normal(scale=rnd.choice([0.02, 0.1, 0.4]), size=8)).astype(np.float32)
            rows.append((len(rows), x.tolist(), 0 if c % 3 else c))
    rows += [(i + 200, rows[5][1], 1) for i in range(20)] + [(i + 300, rows[5][1], 0) for i in range(9)]
    bad = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [math.nan] * 8, [math.inf] + [0.0] * 7]
    rows += [(i + 400, v, 0) for i, v in enumerate(bad)]
    rows += [(500, rows[0][1], None), (50, rows[7][1], 0), (100, rows[7][1], 0), (None, rows[9][1], 0)]
    rows += [(501, [1.0, 2.0], 0), (502, [2.0, 4.0], 0), (503, [1.0, 2.0, 0.0], 0)]
    return rows


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


LARGE = [[5000.0, 1.0], [1e18] * 8, [-3e30, 2.0] + [0.5] * 6, [3e30] * 8, [2.0**70, -(2.0**70)], [1e4] * 8]


def plain_top_k(rows, every, k):
    whole = lambda x: int(x) * 256 if abs(x) >= 2**52 else math.floor(256 * x)
    weights = [(i, [whole(float(np.float32(x))) for x in v]) for i, v, _ in rows if usable(v)]
    want = []
    for at, (i, q) in enumerate(weights):
        if i is not None and i % every == 0:
            scored = [
                (-sum(a * b for a, b in zip(q, w)), j is None, j or 0, j)
                for n, (j, w) in enumerate(weights)
                if n != at
            ]
            clamped = lambda s: max(-(2**63), min(2**63 - 1, -s))
            want += [(i, n + 1, j, clamped(s)) for n, (s, _, _, j) in enumerate(sorted(scored)[:k])]
    return want


@pytest.mark.parametrize("shard,shards,block,first,large", [
    (4096, 8, 512, 256, False), (32, 1, 3, 8, False), (16, 3, 7, 4, True), (4096, 8, 512, 2, True),
])
def test_top_k(spark, monkeypatch, shard, shards, block, first, large):
    """Also with components of any finite size, among the queries and the others."""
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "SHARDS", shards)
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk, "FIRST", first)
    rows = awkward(1)
    if large:
        rows += [(600 + 25 * n, v, 0) for n, v in enumerate(LARGE)]
    found = topk.top_k(vectors(spark, rows).coalesce(1), F.col("vec_id") % 50 == 0, 5).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, plain_top_k(rows, 50, 5)))


def test_top_k_of_few_and_none(spark):
    few = topk.top_k(vectors(spark, [(0, [1.0], 1), (1, [-1.0], 1), (50, [0.5], 1)]), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, few.collect())) == [(0, 1, 50, 32768), (0, 2, 1, -65536), (50, 1, 0, 32768), (50, 2, 1, -32768)]
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 50 == 0).collect() == []


def test_pruned_search_is_full_search():
    rnd = np.random.default_rng(3)
    weights = rnd.integers(-150, 150, (3000, 16)).astype(float)
    weights[rnd.random(weights.shape) < 0.5] = 0  # sparse: many postings are absent
    index = topk.Shard(weights)
    for n in range(40):
        rows, scores = index.search(weights[n], 5, n)
        all_scores = weights @ weights[n]
        all_scores[n] = -np.inf
        least = np.sort(all_scores)[-5]
        assert set(rows) == set(np.flatnonzero(all_scores >= least))
        assert (all_scores[rows] == scores).all()


def test_the_score_to_beat_spares_work():
    """Terms multiplied fall with clusters, and again when a shard begins with a known score."""
    rnd = np.random.default_rng(6)
    centre = rnd.integers(-200, 200, (40, 64)) * (rnd.random((40, 64)) < 0.3)
    weights = (centre[rnd.integers(0, 40, 6000)] + rnd.integers(-4, 5, (6000, 64))).astype(float)
    first, second = topk.Shard(weights[:3000]), topk.Shard(weights[3000:])
    alone, every = 0, 0
    for n in range(30):
        _, scores = first.search(weights[n], 5, n)
        beat = np.sort(scores)[-5]
        before = second.multiplied
        rows, _ = second.search(weights[n], 5, -1)
        alone += second.multiplied - before
        before = second.multiplied
        better, found = second.search(weights[n], 5, -1, float(beat))
        every += second.multiplied - before
        all_scores = weights[3000:] @ weights[n]
        assert set(better) <= set(np.flatnonzero(all_scores >= beat))
        assert len(better) >= min(5, (all_scores >= beat).sum()) and (all_scores[better] == found).all()
    assert first.multiplied < 0.5 * 30 * 3000 * 64
    assert every < 0.8 * alone < 0.5 * 30 * 3000 * 64


@pytest.mark.parametrize("tree,leaf", [(2048, 32), (16, 2)])
def test_near_vectors(spark, monkeypatch, tree, leaf):
    monkeypatch.setattr(covertree, "TREE", tree)
    monkeypatch.setattr(covertree, "LEAF", leaf)
    rows = awkward(2)
    n = len(rows)
    links, label = [0] * n, list(range(n))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if a is None or a != b or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            x, y = np.array(v), np.array(w)
            size = math.sqrt(x @ x) * math.sqrt(y @ y)
            if size and x @ y / size >= 0.98:
                links[i] += 1
                links[j] += 1
                label[top(i)] = top(j)
    least = {}
    for i, (vec_id, *_) in enumerate(rows):
        if vec_id is not None:
            least[top(i)] = min(least.get(top(i), vec_id), vec_id)
    want = [(r[0], links[i], least.get(top(i))) for i, r in enumerate(rows)]
    found = covertree.near_vectors(vectors(spark, rows)).collect()
    assert sorted(repr((r.vec_id, r.n_links, r.component_id)) for r in found) == sorted(map(repr, want))
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert covertree.near_vectors(vectors(spark, [])).collect() == []


def test_cover_tree_holds_its_invariants():
    rnd = np.random.default_rng(8)
    x = rnd.normal(size=(500, 6))
    x[100:200] = x[:100] + rnd.normal(scale=0.01, size=(100, 6))
    tree = covertree.CoverTree(x / np.linalg.norm(x, axis=1)[:, None])
    assert sorted(tree.order.tolist()) == list(range(500))
    for node, children in enumerate(tree.children):
        points = tree.order[tree.start[node] : tree.end[node]]
        apart = np.linalg.norm(tree.unit[points] - tree.unit[tree.centre[node]], axis=1)
        assert apart.max() <= tree.radius[node] + 1e-6
        if len(children):
            assert tree.centre[children[0]] == tree.centre[node]
            assert [tree.start[c] for c in children[1:]] == [tree.end[c] for c in children[:-1]]


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(40)]  # a long chain
    links += [(1000, i) for i in range(1001, 1200)]  # a hub
    links += [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)] + [(7, 7), (1, 0)]
    label = {}

    def top(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((top(a), top(b)))
            label[y] = x
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((x, top(x)) for x in label)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# -------------------------------------------------------------------------- URLs

URLS = [
    ("http://a.example.net/en/1?x=1&y=2#z", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://B.Example.NET/fr/", "b.example.net", "/fr/", "net/", "block"),
    ("http://example.net", "example.net", "", None, None),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("http://example.com/de/?q", "example.com", "/de/", "example.com/de/", "block"),
    ("http://x.org/fr/a://b", "x.org", "/fr/a://b", "org/fr/", "allow"),
    ("http://x.org?fr/", "x.org", "", None, None),
    ("http://x.org#/fr/", "x.org", "", None, None),
    ("x.org/fr/", "", "", None, None),
    ("://", "", "", None, None),
    ("http:///net/", "", "/net/", None, None),
    ("http://\n.net/\n", "\n.net", "/\n", "net/", "block"),
    ("http://ÀB.net/", "Àb.net", "/", "net/", "block"),
    ("", "", "", None, None),
    (None, "", "", None, None),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "x", 1.5) for i, u in enumerate(URLS)], "page_id int, url string, host string, score double")
    ruled = urls.with_rules(pages, queries.RULES)
    found = [tuple(r)[1:] for r in ruled.orderBy("page_id").collect()]
    assert found == URLS
    judged = urls.judge(ruled, urls.learn(ruled)).orderBy("page_id").collect()
    assert [r.verdict for r, u in zip(judged, URLS) if u[4]] == [u[4] for u in URLS if u[4]]
    assert {r.verdict for r in judged} == {"allow", "block"}
    none = ruled.limit(0)
    assert urls.judge(none, urls.learn(none)).collect() == []
    assert {r.verdict for r in urls.judge(ruled.filter("rule is null"), urls.learn(none)).collect()} == {"allow"}


def test_trees_learn_from_two_features_at_once(spark):
    """Held-out accuracy on URLs whose label depends on two features at once."""
    rnd = random.Random(6)
    rows = []
    for i in range(3000):
        digits, deep = rnd.random() < 0.5, rnd.random() < 0.5
        name = "".join(rnd.choices("0123456789" if digits else "abcdefghij", k=8))
        path = "/".join(rnd.choices(["news", "item", "page"], k=5 if deep else 1))
        label = "block" if digits and deep else "allow"
        rows.append((i, f"http://{name}.example.com/{path}", f"{name}.example.com", f"/{path}", None if i % 3 else label, label))
    df = spark.createDataFrame(rows, "page_id int, url string, host string, path string, verdict string, truth string")
    ruled = df.selectExpr("page_id", "url", "host", "path", "CAST(NULL AS STRING) AS rule", "verdict")
    found = urls.judge(ruled.filter("verdict is null"), urls.learn(ruled)).join(df.select("page_id", "truth"), "page_id")
    right = found.filter("verdict = truth").count() / found.count()
    assert right > 0.97


# ----------------------------------------------------------------------- queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.SQL)
def test_query_against_its_sql(spark, name):
    assert difference(spark, FOLDER, queries.QUERIES[name], queries.SQL[name]) is None


@pytest.mark.parametrize("name,table,key", [
    ("op2_toxicity", "documents", "doc_id"), ("op3_embedding_near_dedup", "embeddings", "vec_id"),
    ("op4_token_counts", "documents", "doc_id"), ("op5_token_files", "documents", "doc_id"),
    ("op6_language_id", "documents", "doc_id"), ("op8_url_filter", "pages", "page_id"),
    ("op9_simhash_near_dedup", "documents", "doc_id"), ("op10_best_fit_packing", "documents", "doc_id"),
])
def test_query_covers_its_whole_table(spark, name, table, key):
    found = queries.QUERIES[name](spark, FOLDER)
    source = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    assert sorted({r[0] for r in found.select(key).collect()}) == sorted(r[0] for r in source.select(key).collect())
    if name == "op6_language_id":
        judged = found.filter("held_out").join(source.select("doc_id", "lang"), "doc_id")
        assert judged.filter("lang_pred = lang").count() >= 0.95 * judged.count()
    if name == "op2_toxicity":
        labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toDF("doc_id", "quality", "known")
        assert found.join(labels, "doc_id").filter("toxic AND known = 0").count() <= 1


def test_recall_of_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = queries.toxicity.learn(docs, labels.filter("doc_id % 4 <> 1"))
    found = queries.toxicity.severity(docs, model).withColumnRenamed("toxic", "called")
    judged = found.join(labels.filter("doc_id % 4 = 1"), "doc_id")
    toxic = judged.filter("toxic = 1")
    assert toxic.filter("called").count() >= 0.9 * toxic.count()
    assert judged.filter("toxic = 0 AND called").count() <= 0.01 * judged.count()
