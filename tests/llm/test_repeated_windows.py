import hashlib
import random
import re

import numpy as np
import pytest

from rodovia.llm import repeated_windows, word_hashes
from rodovia.llm.repeated_windows import WINDOW, remove_repeated_windows, window_classes


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(rows):
    """Sorted (doc_id, n_words, n_removed, sha256), row by row."""
    first = {}
    for d, t in rows:
        w = split(t)
        for i in range(len(w) - WINDOW + 1 if d is not None else 0):
            s = tuple(w[i:i + WINDOW])
            first[s] = min(d, first.get(s, d))
    out = []
    for d, t in rows:
        w = split(t)
        gone = [False] * len(w)
        for i in range(len(w) - WINDOW + 1 if d is not None else 0):
            if first[tuple(w[i:i + WINDOW])] < d:
                gone[i:i + WINDOW] = [True] * WINDOW
        kept = " ".join(x for x, g in zip(w, gone) if not g).encode()
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    rows = remove_repeated_windows(frame).collect()
    for r in rows:
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"].split()) == r["n_words"] - r["n_removed"]
    return sorted((tuple(r)[:4] for r in rows), key=str)


def corpus(seed, n=120):
    """Copies, near copies, shared passages in ever new surroundings, passages twice in one document, repeated ids."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "A", "a"]
    text = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, whole, cyclic = text(70), text(160), (["x", "y", "z"] * 60)
    rows = []
    for d in rng.sample(range(1000), n):
        w = text(rng.choice([0, 3, 49, 50, 51, 120, 200]))
        kind = rng.randrange(8)
        if kind == 0:
            w = list(whole)
        elif kind == 1:
            w = list(whole)
            w[rng.randrange(160)] = "changed"
        elif kind in (2, 3):
            w = w + passage[:rng.choice([49, 50, 60, 70])] + text(30)
        elif kind == 4:
            w = w + passage + text(5) + passage
        elif kind == 5:
            w = cyclic[rng.randrange(3):][:rng.choice([50, 90, 150])] + w
        rows.append((d, rng.choice([" ", "\n", "  ", "\t \r\n"]).join(w)))
    rows += [(rows[0][0], rows[0][1]), (rows[1][0], " ".join(whole)), (rows[2][0], "short"), (None, " ".join(whole)), (2000, None), (2001, "")]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_corpus(spark, monkeypatch, small):
    if small:  # many buckets, flushes and pieces, common strings and varied minimisers
        monkeypatch.setattr(repeated_windows, "BUCKET_BYTES", 10_000)
        monkeypatch.setattr(repeated_windows, "FLUSH_BYTES", 8_000)
        monkeypatch.setattr(repeated_windows, "COMMON", 3)
        monkeypatch.setattr(repeated_windows, "SAMPLE", 1)
        monkeypatch.setattr(repeated_windows, "VARIED", 6)
        monkeypatch.setattr(repeated_windows, "SORTED_WORDS", 200)
        monkeypatch.setattr(word_hashes, "PIECE_BYTES", 300)
    rows = corpus(1 + small)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, row string, at int")
    want = expected(rows)
    assert sum(r[2] > 0 for r in want) > 40
    assert found(frame.repartition(3)) == want
    assert found(frame.coalesce(1)) == want


def test_documents(documents):
    frame, rows = documents
    assert found(frame) == expected(rows)


def test_odd_rows(odd, empty):
    assert found(odd) == expected([tuple(r) for r in odd.select("doc_id", "text").collect()])
    assert found(empty) == [] and found(odd.filter("text is null")) == expected([(3, None)])


def test_window_classes_are_exact():
    rng = random.Random(3)
    strings = [" ".join(rng.choice("ab") if i % 60 == 0 else "c" for i in range(rng.randrange(50, 130))).encode() for _ in range(60)]
    windows = [tuple(w[i:i + WINDOW]) for w in (s.split() for s in strings) for i in range(len(w) - WINDOW + 1)]
    cls = window_classes(strings)
    assert len(cls) == len(windows) and len(np.unique(cls)) == len(set(windows)) == len(set(zip(cls.tolist(), windows)))
