import collections
import random
import re
import zlib

import pytest

from rodovia.llm import spelling
from rodovia.llm.spelling import neighbours, spelling_variants
from tests.llm.brute import UPPER


def words_of(rows, drop_every=199):
    n = collections.Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(UPPER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % drop_every == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            n[w] += 1
    return n


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + 1:] == b[p + 1:] or a[p + 1:] == b[p:] or a[p:] == b[p + 1:]


def expected(rows, drop_every=199):
    n = {w: k for w, k in words_of(rows, drop_every).items() if len(w) >= 6 and k >= 5}
    form, near = {}, {}
    for w in n:
        near[w] = [x for x in n if one_apart(w, x)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def found(frame, **more):
    return sorted((tuple(r) for r in spelling_variants(frame, **more).collect()), key=str)


def mutated(rng, w):
    at, c = rng.randrange(len(w) + 1), rng.choice("abé")
    return rng.choice([w[:at] + c + w[at:], w[:at] + w[at + 1:], w[:at] + c + w[at + 1:]])


@pytest.mark.parametrize("length", [6, 9, spelling.LONG])
def test_neighbours(spark, length):
    """Also around the length from which words meet by hashes, with letters in a row."""
    rng = random.Random(length)
    found_words = {"a" * k for k in range(length - 1, length + 4)} | {"ab" * (length // 2), "ba" * (length // 2)}
    seeds = ["".join(rng.choice("abé") for _ in range(length)) for _ in range(12)]
    for _ in range(120):
        w = rng.choice(seeds)
        for _ in range(rng.randrange(3)):
            w = mutated(rng, w)
        found_words.add(w)
    found_words = sorted(w for w in found_words if len(w) >= 6)
    frame = spark.createDataFrame([(w,) for w in found_words], "word string")
    got = sorted(tuple(r) for r in neighbours(frame).collect())
    assert got == sorted((a, b) for a in found_words for b in found_words if one_apart(a, b)) and got


def test_counts_forms_and_roots(spark):
    rng = random.Random(7)
    often = ["example", "samples", "Straßen", "ÉCOLIER", "lengthy", "a" * 60, "b" * 300]
    rows = [(1, "root " * 10 + " ".join(["chainx"] * 5 + ["chainxy"] * 25 + ["chainxyz"] * 130 + ["tieaaa"] * 5 + ["tieaab", "tieaac"] * 30))]
    rows += [(d, ", ".join(rng.choice(often) if rng.random() < 0.8 else mutated(rng, rng.choice(often)) for _ in range(60))) for d in range(2, 60)]
    rows += [(rows[1][0], rows[1][1]), (None, rows[2][1]), (100, None), (101, ""), (102, "× ÷ 12 a1b")]
    want = expected(rows, 7)
    by_word = {r[0]: r for r in want}
    assert by_word["chainx"][1:3] == ("chainxy", "chainxyz") and by_word["tieaaa"][1] == "tieaab"
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, word string, n string")
    assert found(frame.repartition(3), drop_every=7) == want


def test_pieces_and_passing_on(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 20)
    monkeypatch.setattr(spelling, "HASHES", 16)
    monkeypatch.setattr("rodovia.llm.word_hashes.PIECE_BYTES", 200)
    rng = random.Random(9)
    stems = ["".join(rng.choice("abcde") for _ in range(k)) for k in (6, 7, 9, 70)]
    rows = [(d, " ".join(rng.choice(stems) if rng.random() < 0.7 else mutated(rng, rng.choice(stems)) for _ in range(400))) for d in range(4)]
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == expected(rows)


def test_odd_rows(odd, empty):
    assert found(odd) == expected([tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert found(empty) == []
