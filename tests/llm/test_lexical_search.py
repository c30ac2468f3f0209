import collections
import math
import re

import numpy as np
import pytest

from rodovia.llm import lexical_search, word_hashes
from rodovia.llm.lexical_search import nra, ranked_documents
from tests.llm.brute import UPPER
from tests.llm.conftest import SF


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def ranked(docs, items, k=10):
    counts = [(d, collections.Counter(terms(t))) for d, t in docs if d is not None and terms(t)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i] |= set(terms(t))
    out = []
    for i, own in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in own if c[t])
            if s > 0:
                scored.append((-s, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def got(docs, items, **more):
    return sorted(tuple(r) for r in ranked_documents(docs, items, **more).collect())


def test_documents(spark, documents, monkeypatch):
    frame, rows = documents
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = ranked(rows, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert want and got(frame, items) == want
    # Many blocks of items, small shards and short reads.
    monkeypatch.setattr(lexical_search, "BLOCK_PAIRS", 700)
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", 16)
    monkeypatch.setattr(lexical_search, "READ", 2)
    assert got(frame.repartition(3), items) == want


def test_intervals_resolve_membership_and_ties(monkeypatch):
    monkeypatch.setattr(lexical_search, "READ", 1)
    rng = np.random.default_rng(5)
    for n_lists, n_docs, most in ((1, 30, 3), (4, 50, 4), (7, 200, 1000), (12, 9, 2)):
        for floor in (1, 3):
            lists, total = [], np.zeros(n_docs, np.int64)
            for _ in range(n_lists):
                docs = rng.permutation(n_docs)[:rng.integers(0, n_docs + 1)]
                gain = np.sort(rng.integers(1, most + 1, len(docs)))[::-1]
                lists.append((docs, gain))
                total[docs] += gain
            found, score = nra(lists, n_docs, 5, floor)
            least = max(floor, 1, int(np.sort(total)[-5]))
            assert sorted(zip(found, score)) == [(d, s) for d, s in enumerate(total) if s >= least]


def test_odd_rows(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(word_hashes, "PIECE_BYTES", 1000)
    items = spark.createDataFrame(
        [(1, "a lorem Dolor", "x"), (1, "two", "x"), (2, None, "x"), (None, "a b", "x"), (3, "", "x"), (4, "h 12 nowhere", "x"),
         (4, "h 12 nowhere", "x"), (5, "words! ÀB", "x")], "item_id bigint, text string, score string")
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()] + [(11, "àb ÀB Àb-zz"), (12, "ÀB ÀB")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = ranked(rows, [tuple(r)[:2] for r in items.collect()])
    assert {r[0] for r in want} == {1, 4, 5} and got(frame, items) == want
    assert got(odd, items) == ranked(rows[:-2], [tuple(r)[:2] for r in items.collect()])
    assert got(empty, items) == [] and got(odd, items.limit(0)) == [] and got(frame.filter("text is null"), items) == []


@pytest.mark.parametrize("size", [word_hashes.LONGEST - 1, word_hashes.LONGEST, 3 * word_hashes.LONGEST + 5])
def test_very_long_words(size):
    raw = np.frombuffer(("x" * size + " " + "x" * (size - 1) + " " + "x" * size).encode(), np.uint8)
    hashed, first = lexical_search._TERMS.words(raw, np.array([0, len(raw)]))
    assert len(hashed) == 3 and hashed[0] == hashed[2] != hashed[1] and list(first) == [0, 3]
