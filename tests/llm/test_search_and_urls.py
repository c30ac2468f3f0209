import math
import random

from rodovia.llm import topk, url_filter
from rodovia.llm.topk import top_k
from rodovia.llm.url_filter import build_cascade, judge_urls, member
from pyspark.sql import functions as F
from tests.llm.conftest import SF


def brute_top_k(rows, k=5, every=50):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in vectors if i % every == 0}):
        asked = min((r[1] for r in rows if r[0] == q and (q, [math.floor(256 * x) for x in r[1] or [] if x is not None and math.isfinite(x)]) in vectors))
        asked = [math.floor(256 * x) for x in asked]
        scored = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(asked, v)))), i) for i, v in vectors if i != q and len(v) == len(asked))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_embeddings(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in frame.collect()]
    assert sorted(tuple(r) for r in top_k(frame.repartition(3)).collect()) == brute_top_k(rows)


def test_ties_gaps_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VALUES", 6)  # several blocks of queries
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.0, 0.5, -0.5, 1e6]) for _ in range(3)]) for i in range(0, 400, 5)]
    rows += [(1, None), (2, []), (3, [1.0, None, 0.0]), (4, [float("nan"), 0.0, 0.0]), (6, [float("inf"), 0.0, 0.0]),
             (None, [1.0, 1.0, 1.0]), (50, list(rows[10][1])), (7, [9.0, 9.0, 9.0]), (7, [9.0, 9.0, 9.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score string")
    assert sorted(tuple(r) for r in top_k(frame).collect()) == brute_top_k(rows)
    assert top_k(frame.limit(0)).count() == 0
    assert top_k(frame.filter("vec_id in (0, 5)")).count() == 1


def test_values_beyond_doubles(spark):
    rows = [(0, [2.0 ** 30, 1.0]), (1, [2.0 ** 24, 3.0]), (2, [1.0, 1.0]), (50, [1e300, 0.0])]
    got = sorted(tuple(r) for r in top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), k=2).collect())
    want = brute_top_k(rows, k=2)
    assert got == want


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("x.org", "", "block")]


def judged(spark, urls, rules=RULES):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id int, url string, verdict string")
    frame = judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert frame.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    return [tuple(r)[2:] for r in frame.orderBy("page_id").collect()]


def test_urls(spark):
    assert judged(spark, ["http://A.Example.com/en/1?x=/es/", "https://www.example.com/en/", "http://example.com", None,
                          "no scheme", "http://notexample.com/en/", "http://a.net/es", "http://a.net/es/#/", "ftp://x.org",
                          "http://y.x.org?q", "://com/", "http://com/a://b/en/", "http:///es/"]) == [
        ("a.example.com", "/en/1", "example.com/en/", "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("example.com", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("notexample.com", "/en/", "com/", "allow"), ("a.net", "/es", None, "allow"), ("a.net", "/es/", "net/es/", "block"),
        ("x.org", "", "x.org", "block"), ("y.x.org", "", "x.org", "block"), ("com", "/", "com/", "allow"),
        ("com", "/a://b/en/", "com/", "allow"), ("", "/es/", None, "allow")]


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.com/"], [(None, "/", "block"), ("", "/", "block")]) == [("a.com", "/", None, "allow")]
    assert judged(spark, []) == []


def test_cascade_is_exact_on_its_universe(spark, monkeypatch):
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.filter(F.xxhash64("key") % 37 == 0).unionByName(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    levels = build_cascade(listed, universe)
    assert len(levels) > 1
    wrong = (universe.join(listed.withColumn("in", F.lit(True)), "key", "left")
             .filter(member(levels, F.col("key")) != F.coalesce("in", F.lit(False))))
    assert wrong.count() == 0
    assert build_cascade(listed.limit(0), universe) == []


def test_long_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "LISTED", 40)
    rules = [(f"h{i}.com", f"/{i % 3}/", "block" if i % 2 else "allow") for i in range(100)] + [("com", "/1", "block")]
    got = judged(spark, [f"http://w.h{i}.com/{i % 3}/x" for i in range(100)] + ["http://other.com/1/", "http://other.com/2/"], rules)
    for i in range(100):
        assert got[i][2:] == (f"h{i}.com/{i % 3}/", "block" if i % 2 else "allow")
    assert [g[2] for g in got[100:]] == ["com/1", None]


def test_packaged_plan_is_native(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    frame = judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan
