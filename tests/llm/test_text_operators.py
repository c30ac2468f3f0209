"""Decontamination, repeated spans, licenses, language and line de-duplication."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from rodovia.llm.decontamination import contained_items, without_items
from rodovia.llm.language_id import held_out, learn_profiles, predict_languages, with_languages
from rodovia.llm.license_scan import NOTICES, TEMPLATES, find_licenses
from rodovia.llm.line_dedup import drop_site_lines
from rodovia.llm.repeated_spans import common_prefixes, remove_repeats, suffix_array
from tests.llm import brute
from tests.llm.conftest import LONG, ODD, SF


def test_contained_items(spark, documents):
    frame, rows = documents
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute.contained(rows, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert sorted((tuple(r) for r in contained_items(frame, items).collect()), key=str) == want
    clean = {r["doc_id"] for r in without_items(frame, items).collect()}
    assert clean == {d for d, _ in rows} - {w[0] for w in want}


def test_items_scattered_in_long_documents(spark):
    """Three quarters of an item's shingles in far-apart passages, items of all sizes."""
    rng = random.Random(5)
    filler = [f"f{rng.randrange(3000)}" for _ in range(8000)]
    items, docs = [], []
    for i, n in enumerate([1, 3, 5, 9, 12, 20, 40, 70, 150, 300]):
        w = [f"i{i}_{k}" for k in range(n)]
        items.append((i, " ".join(w)))
        for share in (1.0, 0.8, 0.7):
            cut = max(1, int(n * share))
            a = w[:cut // 2 + 4]
            b = w[cut // 2:cut]
            docs.append((len(docs), " ".join(filler[:3000] + a + filler[3000:6000] + b + filler[6000:])))
    items += [(98, None), (99, " ")]
    got = contained_items(spark.createDataFrame(docs, "doc_id bigint, text string"),
                          spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute.contained(docs, items)


def test_items_in_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "two words", 5), (None, "A b c D e f g h", 6), (3, None, 7)], "item_id bigint, text string, doc_id int")
    got = [tuple(r)[:2] for r in contained_items(odd, items).collect()]
    assert sorted(got, key=str) == sorted([(6, 1), (7, 1), (7, 1), (1, None), (2, None), (None, None)], key=str)
    assert without_items(odd, items).columns == odd.columns
    assert without_items(odd, items).count() == len(ODD) - 6
    assert contained_items(empty, items).count() == 0 and without_items(empty, items).count() == 0
    assert contained_items(odd, items.limit(0)).count() == 0 and without_items(odd, items.limit(0)).count() == len(ODD)


def repeats(frame):
    return {r["doc_id"]: tuple(r)[1:5] for r in remove_repeats(frame).collect()}


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 99, 2000).astype(np.uint8)
    text = np.concatenate([text, text[:400], text[100:300]])
    order, packed = suffix_array(text)
    raw = text.tobytes()
    assert [raw[i:i + 64] for i in order] == sorted((raw[i:i + 64] for i in range(len(raw))), key=lambda s: s.ljust(64, b"\0"))
    common = common_prefixes(order, packed)
    for k in range(1, len(order)):
        x, y = raw[order[k]:order[k] + 64], raw[order[k - 1]:order[k - 1] + 64]
        n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        if min(len(x), len(y)) == 64:
            assert common[k] == n


def test_repeats_of_documents(documents):
    frame, rows = documents
    assert repeats(frame) == brute.repeats(rows)


def test_repeats_with_a_hot_passage(spark):
    """A passage in most documents with other neighbours each time: hot spans, and anchors with many spans."""
    rng = random.Random(7)
    passage = " ".join(f"p{rng.randrange(900)}" for _ in range(40))
    rows = [(d, " ".join(f"{rng.randrange(10 ** 6)}" for _ in range(20)) + passage[:rng.randrange(60, len(passage))] +
             "".join(rng.choice("abcdé") for _ in range(rng.randrange(80)))) for d in range(400)]
    rng.shuffle(rows)
    assert repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)) == brute.repeats(rows)


def test_repeats_merge_shards(spark, documents, monkeypatch):
    """The same with shards so small that anchors fill several and are merged."""
    from rodovia.llm import repeated_spans

    monkeypatch.setattr(repeated_spans, "SHARD_SPANS", 20)
    frame, rows = documents
    assert repeats(frame.limit(120)) == brute.repeats([tuple(r) for r in frame.limit(120).select("doc_id", "text").collect()])


def test_repeats_of_ids_with_several_texts(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(248))
    rows = [(1, long), (2, long[20:] + "tail of the first"), (2, "short"), (2, long[20:] + "tail of the first"), (2, "own " * 30), (3, "own " * 30),
            (3, long), (None, long)]
    got = sorted((tuple(r)[:5] for r in remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()), key=str)
    want = []
    for d, t in rows:
        if d is None:
            want.append((d, len(t), 0, 0, hashlib.sha256(t.encode()).hexdigest()))
        else:
            others = [(e, u) for e, u in rows if e is not None and e < d]
            # Each row by itself against the smaller ids: ids of rows with other texts must not count.
            numbered = [(k, u) for k, (_, u) in enumerate(sorted(others))] + [(len(others), t)]
            want.append((d, *brute.repeats(numbered)[len(others)]))
    assert got == sorted(want, key=str)


def test_repeats_hold_little_at_once():
    """What steps hold of a batch while they work, in bytes a byte of text, and how much of it goes back to Spark at once."""
    import tracemalloc

    import pyarrow as pa

    from rodovia.llm import repeated_spans

    def peak(step, batches):
        tracemalloc.start()
        try:
            out = list(step(iter(batches)))
            return out, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    rng = random.Random(11)
    texts = ["".join(rng.choices("abcdefgh ", k=2000)) for _ in range(2000)]
    texts += texts[:1000]
    n = sum(map(len, texts))
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["doc", "row", "text"])
    blocks, held = peak(repeated_spans._scan(1000), [batch])
    assert held < 5.5 * n
    assert max(b.nbytes for b in blocks) < 2 << 20
    blocks, held = peak(repeated_spans._scan(1), [batch])
    spans = pa.concat_arrays([b.column(1) for b in blocks])
    shard = pa.RecordBatch.from_arrays([pa.array([0] * len(spans), pa.int32()), spans], ["shard", "spans"])
    settled, held = peak(repeated_spans._settle, [shard])
    assert held < 8 * n
    assert sum(b.num_rows for b in settled) > 0
    pressed, _ = peak(repeated_spans._compressed, [batch])
    assert [r for b in pressed for r in b.column(0).to_pylist()] == ids.to_pylist()
    assert max(b.num_rows for b in pressed) <= 512
    whole = pa.concat_arrays([b.column(2) for b in pressed])
    places = pa.array([[{"at": 5, "n": 1}]] * len(ids), pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int32())])))
    cut, _ = peak(repeated_spans._cut_out, [pa.RecordBatch.from_arrays([ids, whole, places], ["doc", "text", "places"])])
    assert [r for b in cut for r in b.column(0).to_pylist()] == ids.to_pylist()
    assert all(r == t[:5].encode() + t[55:].encode() for r, t in zip((r for b in cut for r in b.column(5).to_pylist()), texts))
    assert max(b.num_rows for b in cut) <= 512


def test_repeats_in_odd_rows(odd, empty):
    got = sorted((tuple(r)[:4] for r in remove_repeats(odd).collect()), key=str)
    n = len(LONG)
    small = [(d, len((t or "").encode()), 0, 0) for d, t, *_ in ODD if d not in (9, 10)]
    assert got == sorted(small + [(9, n, 0, 0), (10, n, n, 1)], key=str)
    by = {r["doc_id"]: r["kept_sha256"] for r in remove_repeats(odd).collect()}
    assert by[10] == by[3] == hashlib.sha256(b"").hexdigest()
    assert remove_repeats(empty).count() == 0


def test_licenses(documents):
    frame, rows = documents
    got = {}
    for r in find_licenses(frame).collect():
        got.setdefault(r["doc_id"], {})[r["license"]] = list(zip(r["begins"], r["ends"]))
    want = {d: x for d, t in rows if (x := brute.licenses(t, TEMPLATES))}
    assert got == want


GRANT = TEMPLATES["MIT"][1]


def test_licenses_in_odd_rows(spark, odd, empty):
    assert find_licenses(odd, {"two": ["Two WORDS"], "none": [" "]}).select("doc_id", "license").collect() == [
        (6, "two"), (7, "two"), (7, "two")]
    assert find_licenses(empty).count() == 0 and find_licenses(odd, {}).count() == 0
    text = "x " * 500 + GRANT.upper() + " y" * 300 + " " + GRANT
    rows = find_licenses(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()
    assert [(r["license"], len(r["begins"])) for r in rows] == [("MIT", 2)]


def test_licenses_at_every_place(spark, monkeypatch):
    """A notice with foreign words in its middle, after 0 to 63 other words, in texts of one piece and of many."""
    w = GRANT.split()
    broken = w[:len(w) // 2] + [f"foreign{i}" for i in range(30)] + w[len(w) // 2:]
    docs = [(k, " ".join([f"before{i}" for i in range(k)] + broken + ["after"] * 200)) for k in range(64)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for piece in (1 << 20, 100):
        monkeypatch.setattr("rodovia.llm.word_hashes.PIECE_BYTES", piece)
        got = {r["doc_id"]: list(zip(r["begins"], r["ends"])) for r in find_licenses(frame).collect()}
        assert got == {d: brute.licenses(t, TEMPLATES)["MIT"] for d, t in docs}


def test_licenses_with_edits_everywhere(spark):
    """Notices with words changed at random: the share found of those that hold three quarters."""
    rng = random.Random(12)
    docs, held = [], {}
    for d in range(150):
        name = rng.choice(["MIT", "GPL-3.0", "LGPL-2.1", "MPL-2.0"])
        words = max(NOTICES[name], key=len).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "changed"
        text = " ".join([f"a{rng.randrange(99)}" for _ in range(rng.randrange(200))] + words + [f"b{i}" for i in range(rng.randrange(200))])
        docs.append((d, text))
        held[d] = set(brute.licenses(text, TEMPLATES))
    got = {}
    for r in find_licenses(spark.createDataFrame(docs, "doc_id bigint, text string")).collect():
        got.setdefault(r["doc_id"], set()).add(r["license"])
    total, found = sum(map(len, held.values())), sum(len(held[d] & got.get(d, set())) for d in held)
    assert total > 80 and found == total and all(got.get(d, set()) <= held[d] for d in held)


def test_whole_licenses_and_altered_notices(spark):
    """Every shipped text in a long document with words changed, the usual notices, and short wordings with other marks."""
    def altered(text):
        w = text.split()
        return " ".join("changed" if i % 60 == 59 else x for i, x in enumerate(w))

    assert {"MIT", "ISC", "BSD-3-Clause", "BSD-2-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0",
            "CC0-1.0"} <= set(TEMPLATES)
    want = [(n, t) for n, texts in TEMPLATES.items() for t in texts if len(t) > 150]
    docs = [(i, "x " * 700 + altered(t) + " y" * 300) for i, (_, t) in enumerate(want)]
    short = ["Released under the MIT License,", "licensed under the Apache License, Version 2.0 (the", "available under the MIT License"]
    docs += [(1000 + i, f"before it {t} and after") for i, t in enumerate(short)] + [(2000, "under the sea the license of words is free")]
    got = {}
    for r in find_licenses(spark.createDataFrame(docs, "doc_id bigint, text string")).collect():
        assert r["license"] not in got.setdefault(r["doc_id"], set())  # one row a license
        got[r["doc_id"]].add(r["license"])
    assert all(n in got.get(i, ()) for i, (n, _) in enumerate(want)), got
    assert [got[1000 + i] for i in range(3)] == [{"MIT"}, {"Apache-2.0"}, {"MIT"}]
    assert 2000 not in got


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = learn_profiles(docs, usable=~held_out(F.col("doc_id")))
    rows = (predict_languages(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id")
            .filter(held_out(F.col("doc_id"))).collect())
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert len(rows) > 100 and right >= 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(odd, empty, documents):
    frame, _ = documents
    profiles = learn_profiles(frame)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict_languages(odd, profiles).collect()}
    assert all(got[d] == ("und", 0.0) for d in (3, 4, 5, 8))
    assert all(got[d][0] in profiles for d in (1, 6, 9))
    assert with_languages(odd, profiles).select("row.*").columns == odd.columns
    assert learn_profiles(empty) == {} and predict_languages(empty, profiles).count() == 0
    assert {r["lang_pred"] for r in predict_languages(odd, {}).collect()} == {"und"}
    assert learn_profiles(odd, sample=1).keys() == {"en", "de", "la"}


def test_profile_order_and_distance(spark):
    rows = [(1, "aa ab", "x"), (2, "ba", "y")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    code = {k: sum(ord(c) << (21 * (len(k) - 1 - i)) for i, c in enumerate(k)) for k in ("a", "b", " a", "aa", " aa")}
    profile = learn_profiles(frame)["x"].tolist()
    assert profile[:2] == [code["a"], code[" a"]]  # three times, then twice
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict_languages(frame, learn_profiles(frame)).collect()}
    assert got == {1: ("x", 1.0), 2: ("y", 1.0)}


def test_site_lines(documents):
    frame, _ = documents
    rows = frame.select("doc_id", "source", "text").collect()
    got = {r["doc_id"]: r["text"] for r in drop_site_lines(frame).collect()}
    assert [got[r["doc_id"]] for r in rows] == brute.site_lines([(r["source"], r["text"]) for r in rows])


def test_site_lines_of_odd_rows(spark, odd, empty):
    out = drop_site_lines(odd)
    assert out.columns == odd.columns + ["_n_lines", "_n_dropped"]
    assert sorted((tuple(r)[:2] for r in out.collect()), key=str) == sorted(
        zip([r[0] for r in ODD], brute.site_lines([(r[3], r[1]) for r in ODD])), key=str)
    assert drop_site_lines(empty).count() == 0
    rows = [(None, "menu\nx"), (None, "menu"), (None, "menu"), ("s", None), ("s", "menu \n\nown"), ("s", " menu"), ("s", "menu\nmenu")]
    got = drop_site_lines(spark.createDataFrame(rows, "source string, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(
        [(None, "menu\nx", 2, 0), (None, "menu", 1, 0), (None, "menu", 1, 0), ("s", None, 0, 0), ("s", "\nown", 3, 1),
         ("s", "", 1, 1), ("s", "", 2, 2)], key=str)


def test_footers_on_few_of_a_site_s_pages(spark):
    """A line on 6, 8 or 10 % of a site's pages goes, one on 4 % or on one page stays."""
    for share in (0.04, 0.06, 0.08, 0.10):
        rows = [("s", f"own {i}\nmore {i}" + ("\nContact us" if i < share * 300 else "")) for i in range(300)]
        rows += [("t", "Contact us\nown")] + [("t", f"page {i}") for i in range(50)]
        frame = spark.createDataFrame(rows, "source string, text string")
        got = sorted(r["text"] for r in drop_site_lines(frame).collect())
        assert got == sorted(brute.site_lines(rows))
        assert sum("Contact us" in t for t in got) == (13 if share == 0.04 else 1)
        assert sum("own" in t for t in got) == 301


def test_ratio_alone_decides_without_a_least_number_of_pages(spark):
    rows = [("s", "a\nb"), ("s", "c")] + [("t", f"x{i}") for i in range(30)]
    got = sorted(r["text"] for r in drop_site_lines(spark.createDataFrame(rows, "source string, text string"), min_pages=1).collect())
    assert got == sorted(brute.site_lines(rows, least=1)) and got[:2] == ["", ""]


def test_languages_against_a_plain_version(spark, documents, monkeypatch):
    """Profiles, prediction and score counted letter by letter, with long texts in pieces."""
    from rodovia.llm import language_id

    monkeypatch.setattr(language_id, "_PIECE", 300)
    frame, rows = documents
    langs = {r["doc_id"]: r["lang"] for r in frame.select("doc_id", "lang").collect()}

    def grams(text):
        words = re.findall(r"[^\W\d_]+", text.lower())
        out = collections.Counter()
        for w in words:
            out.update(w)
            w = f" {w} "
            out.update(w[i:i + 2] for i in range(len(w) - 1))
            out.update(w[i:i + 3] for i in range(len(w) - 2))
        return out

    def top(count):
        return [g for g, _ in sorted(count.items(), key=lambda x: (-x[1], sum(ord(c) << 21 * k for k, c in enumerate(reversed(x[0])))))][:300]

    counts = {}
    for d, t in rows:
        if zlib.crc32(str(d).encode()) % 5:
            counts.setdefault(langs[d], collections.Counter()).update(grams(t))
    profiles = {k: {g: i for i, g in enumerate(top(c))} for k, c in counts.items()}
    want = {}
    for d, t in rows:
        own = top(grams(t))
        apart = sorted((sum(abs(p[g] - i) if g in p else 300 for i, g in enumerate(own)), k) for k, p in profiles.items())
        want[d] = (apart[0][1], 1 - apart[0][0] / (300 * len(own)))
    learned = learn_profiles(frame, usable=~held_out(F.col("doc_id")))
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict_languages(frame, learned).collect()} == want


def test_floors_change_without_a_step():
    """One document more moves a floor a little, whatever their number; with few the floors are low."""
    from rodovia.llm.language_id import floors_of

    rng = random.Random(4)
    scores = [(rng.choice("xy"), rng.randrange(512, 1000), 0.6 + 0.3 * rng.random()) for _ in range(400)]
    assert floors_of([]) == {}
    floors = [floors_of(scores[:n]).get("x", np.zeros(22))[9] for n in range(401)]
    assert floors[0] == 0 and 0 < floors[-1] < 0.6
    assert max(abs(a - b) for a, b in zip(floors[20:], floors[21:])) < 0.1
