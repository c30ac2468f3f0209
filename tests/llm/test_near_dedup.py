import random

import numpy as np
import pyarrow as pa

from rodovia.llm.components import components
from rodovia.llm.near_dedup import near_duplicates, signature
from rodovia.llm.shingles import shingle_sets
from tests.llm import brute


def found(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(frame).collect()}


def test_shingle_sets_have_the_right_sizes(documents):
    _, rows = documents
    texts = [t for _, t in rows] + ["", None, "a", "a\x0bb c d", "É é A a b"]
    for i, s in shingle_sets(pa.array(texts)):
        assert len(s) == len(brute.shingles(texts[i]))
        assert (np.diff(s.astype(object)) > 0).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 100))
    equal = (signature(np.concatenate([both, a])) == signature(np.concatenate([both, b]))).mean()
    assert abs(equal - 0.75) < 0.15


def test_documents(documents):
    frame, rows = documents
    assert found(frame) == brute.near(rows)


def test_one_large_group_with_strays(spark):
    """More near copies than a block holds, some close to the threshold on either side."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(1200):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            w[rng.randrange(60)] = f"x{rng.randrange(40)}"
        rows.append((d, " ".join(w)))
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got == brute.near(rows)


def test_odd_rows(odd):
    got = [tuple(r) for r in near_duplicates(odd).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 4, 1, True), (2, 4, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True),
        (7, 1, 6, False), (7, 1, 6, False), (None, 4, None, True), (8, 1, 8, True), (9, 5, 9, True), (10, 5, 9, False)], key=str)


def test_empty(empty):
    assert near_duplicates(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(5, 5)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


def test_repeated_ids_with_different_texts(spark):
    """Sets of one id belong together, also where copies under other ids tie them to further ones."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b), (9, c), (8, c), (8, ""), (10, None), (10, c + " more"), (11, "other words"), (11, "other words")]
    got = sorted((tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    assert got == sorted([(1, 26, 1, True), (5, 26, 1, False), (5, 26, 1, False), (7, 26, 1, False), (9, 26, 8, False), (8, 26, 8, True),
                          (8, 0, 8, True), (10, 0, 10, True), (10, 27, 8, False), (11, 1, 11, True), (11, 1, 11, True)], key=str)


def test_hot_buckets_move_each_member_a_few_times(spark, monkeypatch):
    """Blocks of 16: one dense group of 500 with strays, and how many rows the exact comparison deals out."""
    from pyspark.sql import functions as F

    from rodovia.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for d in range(500):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            w[rng.randrange(80)] = f"x{rng.randrange(60)}"
        rows.append((d, " ".join(w)))
    for d in range(500, 530):
        w = list(base)
        for _ in range(rng.randrange(3, 6)):
            w[rng.randrange(80)] = f"y{rng.randrange(60)}"
        rows.append((d, " ".join(w)))
    got = found(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert got == brute.near(rows)
    # A component of 500 beside 3 others: each of the large one once, each other one for each block.
    members = spark.createDataFrame([(7, i, 0 if i < 500 else i) for i in range(503)], "bucket bigint, id bigint, label bigint")
    dealt = near_dedup._across(members)
    assert dealt.count() == 500 + 3 * (32 + 1)
    pairs = dealt.alias("x").join(dealt.alias("y"), ["bucket", "lo", "hi"]).filter("x.label < y.label").select("x.id", "y.id").distinct()
    assert pairs.count() == 500 * 3 + 3
