"""Packing, token totals and the pipeline."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rodovia.llm.packing import pack, patterns
from rodovia.llm.token_counts import TokenTotals, count_tokens
from rodovia.llm.word_tokens import WordTokens
from tests.llm import brute
from tests.llm.conftest import LONG, ODD, SF

FILE = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def test_cached_tokens_are_the_library_s(tokenizer, documents, monkeypatch):
    from rodovia.llm import word_tokens

    monkeypatch.setattr(word_tokens, "CACHE_ENTRIES", 500)
    cached = WordTokens()
    odd = ["", "Don't STOP <|endoftext|> é é x ½ ² ª", "A.B,C 12 345 ''s 'll'", " \x0b\x0c\x1f a\x85b\xa0c", "ÀÉß Ünïcode ÷×",
           "a<|b", "it's we'LL I'D.,x ..a,,b !.c", "ǅ İ ſ ﬁ 中文 🙂", "a\0b"]
    for text in [t for _, t in documents[1]] + odd:
        assert np.frombuffer(cached.encode(text), np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts, size=2048):
    """Pieces of each document are complete and in order; sequences are gapless and not too long; returns their number."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    tokenizer = Tokenizer.from_file(FILE)
    for d, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], np.uint32)
        pieces = sorted(by_doc[d], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in pieces] == [
            (i, at, min(size, len(ids) - at)) for i, at in enumerate(range(0, len(ids), size))]
        assert [r["ids_crc32"] for r in pieces] == [zlib.crc32(ids[at:at + size].tobytes()) for at in range(0, len(ids), size)]
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    return len(by_sequence)


def test_documents_fill_sequences(documents):
    frame, rows = documents
    packed = pack(frame).collect()
    n = check_packing(packed, rows)
    assert n <= -(-sum(r["length"] for r in packed) // 2048) + 1


def test_odd_documents(odd, empty):
    rows = pack(odd).collect()
    check_packing(rows, [r[:2] for r in ODD if r[0] not in (7, 9)])
    assert [r["length"] for r in rows if r["doc_id"] == 7] == [3, 3]
    assert sum(r["length"] for r in rows if r["doc_id"] == 9) == len(ids_of(LONG)) + 1
    assert [r["length"] for r in rows if r["doc_id"] in (3, 4, 5)] == [1, 1, 1]
    assert pack(empty).count() == 0
    ids = pack(odd, size=8, with_ids=True).filter("doc_id = 1").orderBy("piece").collect()
    assert b"".join(r["ids"] for r in ids) == np.array(ids_of(ODD[0][1]) + [0], np.uint32).tobytes()


def test_patterns_use_every_piece_once():
    rng = random.Random(2)
    for n, size in ((0, 10), (7, 10), (500, 64), (20000, 2048)):
        counts = collections.Counter(min(size, 1 + int(rng.expovariate(6 / size))) for _ in range(n))
        used = collections.Counter()
        bins = 0
        for times, lengths in patterns(dict(counts), size):
            assert times > 0 and sum(lengths) <= size
            bins += times
            for x in lengths:
                used[x] += times
        assert used == counts
        assert bins <= -(-sum(k * v for k, v in counts.items()) // size) * 1.02 + 1


def test_two_smaller_pieces_replace_the_smallest():
    # Greedy fills 6 + 3 and leaves a gap of 1; 2 + 2 in the place of 3 fills it.
    assert patterns({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])


def totals(t):
    return sorted((tuple(r) for r in t.totals().collect()), key=str)


def test_token_totals(spark, tmp_path):
    t = TokenTotals(spark, f"file://{tmp_path}/totals")
    schema = "op string, source string, lang string, tokenizer string, tokens bigint, old_tokens bigint, docs string"
    assert totals(t) == []
    first = spark.createDataFrame([("insert", "a", "en", "1", 10, None, "x"), ("insert", "a", "en", "1", 5, 7, "x"),
                                   ("insert", None, None, "1", None, None, "x"), ("insert", "b", "en", "2", 3, 0, "x")], schema)
    assert t.apply("b1", first) and not t.apply("b1", first)
    assert totals(t) == sorted([("a", "en", "1", 2, 15), (None, None, "1", 1, 0), ("b", "en", "2", 1, 3)], key=str)
    second = spark.createDataFrame([("revise", "a", "en", "1", 8, 10, "x"), ("delete", "b", "en", "2", 3, None, "x"),
                                    ("delete", "a", "en", "1", 5, None, "x")], schema)
    assert t.apply("b2", second)
    want = sorted([("a", "en", "1", 1, 8), (None, None, "1", 1, 0)], key=str)
    assert totals(t) == want
    t.compact()
    assert totals(t) == want and not t.apply("b1", first) and not t.apply("b2", second) and totals(t) == want
    # A batch that broke off (no commit marker) does not count and may be repeated.
    assert t.apply("b3", first.limit(0)) and totals(t) == want
    (tmp_path / "totals/batches/b3/_SUCCESS").rename(tmp_path / "totals/batches/b3/_broken")
    assert t.apply("b3", second.filter("op = 'revise'").withColumns({"tokens": F.lit(9).cast("bigint"), "old_tokens": F.lit(8).cast("bigint")}))
    assert totals(t) == sorted([("a", "en", "1", 1, 9), (None, None, "1", 1, 0)], key=str)
    t.compact()
    t.compact()
    assert totals(TokenTotals(spark, f"file://{tmp_path}/totals")) == sorted([("a", "en", "1", 1, 9), (None, None, "1", 1, 0)], key=str)
    with pytest.raises(Exception, match="op must be"):
        t.apply("b4", spark.createDataFrame([("upsert", "a", "en", "1", 8, 10, "x")], schema))
    with pytest.raises(ValueError):
        t.apply("a/b", first)


def changes(spark, *rows):
    return spark.createDataFrame(rows, "op string, source string, lang string, tokenizer string, tokens bigint, old_tokens bigint")


def test_totals_under_concurrency(spark, tmp_path, monkeypatch):
    """A batch committed inside a compaction, two compactions at once, two writers of one name, and one that breaks off."""
    root = f"file://{tmp_path}/totals"
    t, other = TokenTotals(spark, root), TokenTotals(spark, root)
    assert t.apply("a", changes(spark, ("insert", "s", "en", "1", 10, 0)))
    publish = TokenTotals._publish

    def meanwhile(self, draft, name):
        monkeypatch.setattr(TokenTotals, "_publish", publish)
        assert other.apply("b", changes(spark, ("insert", "s", "en", "1", 5, 0)))
        return publish(self, draft, name)

    monkeypatch.setattr(TokenTotals, "_publish", meanwhile)
    assert t.compact() and totals(t) == [("s", "en", "1", 2, 15)]

    def overtaken(self, draft, name):
        monkeypatch.setattr(TokenTotals, "_publish", publish)
        assert other.compact() and other.apply("c", changes(spark, ("insert", "s", "en", "1", 1, 0)))
        return publish(self, draft, name)

    monkeypatch.setattr(TokenTotals, "_publish", overtaken)
    assert not t.compact() and totals(t) == [("s", "en", "1", 3, 16)]

    def same_name(self, draft, name):
        monkeypatch.setattr(TokenTotals, "_publish", publish)
        assert other.apply("d", changes(spark, ("insert", "s", "en", "1", 100, 0)))
        return publish(self, draft, name)

    monkeypatch.setattr(TokenTotals, "_publish", same_name)
    assert not t.apply("d", changes(spark, ("insert", "s", "en", "1", 7, 0))) and totals(t) == [("s", "en", "1", 4, 116)]

    def broken(self, draft, name):
        raise OSError("lost")

    monkeypatch.setattr(TokenTotals, "_publish", broken)
    for step in (t.compact, lambda: t.apply("e", changes(spark, ("delete", "s", "en", "1", 1, 0)))):
        with pytest.raises(OSError):
            step()
    monkeypatch.setattr(TokenTotals, "_publish", publish)
    assert totals(t) == [("s", "en", "1", 4, 116)]
    assert t.apply("e", changes(spark, ("delete", "s", "en", "1", 1, 0))) and t.compact()
    # After vacuum the names are still known, and folders hold the newest sum alone.
    assert t.vacuum() == ["a", "b", "c", "d", "e"] and totals(other) == [("s", "en", "1", 3, 115)]
    assert not any(t.apply(b, changes(spark, ("insert", "s", "en", "1", 9, 0))) for b in "abcde")
    assert sorted(p.name for p in (tmp_path / "totals").iterdir()) == ["batches", "done", "sums"]
    assert not list((tmp_path / "totals/batches").iterdir()) and len(list((tmp_path / "totals/sums").iterdir())) == 1
    assert t.apply("f", changes(spark, ("insert", "s", "en", "1", 9, 0))) and t.compact() and totals(t) == [("s", "en", "1", 4, 124)]


def test_counts_of_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b", 7, "x", "y"), (1, "a b", 7, "x", "y")], "id int, text string, n int, _text string, row string")
    got = count_tokens(frame, ["id", "n", "_text", "row"])
    assert got.columns == ["id", "_text", "row", "n"] and [tuple(r) for r in got.collect()] == [(1, "x", "y", 2)] * 2


def test_counts_and_query(spark, odd, empty, documents):
    import base64

    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = sorted((tuple(r) for r in count_tokens(odd, ["doc_id", "n_chars"]).collect()), key=str)
    assert got == sorted([(r[0], r[4], len(enc.encode_ordinary(r[1] or ""))) for r in ODD], key=str)
    assert count_tokens(empty, ["doc_id"]).count() == 0
    from rodovia.llm.queries import op6_token_counts

    docs = documents[0].collect()
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    want = collections.Counter()
    for r in docs:
        if r["doc_id"] not in toxic:
            want[r["source"], r["lang"], "words-1"] += len(brute.words(r["text"]))
            want[r["source"], r["lang"], "byte_bpe_50k-1"] += len(enc.encode_ordinary(r["text"]))
    assert toxic and {tuple(r)[:3]: r["tokens"] for r in op6_token_counts(spark, SF).collect()} == dict(want)


def test_pipeline(spark, documents):
    """Every stage against the plain versions, on what the stage before it kept."""
    frame, _ = documents
    docs = [tuple(r) for r in frame.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    lines = brute.site_lines([(r[3], r[1]) for r in docs])
    docs = [(r[0], t, *r[2:]) for r, t in zip(docs, lines)]
    groups = brute.near([r[:2] for r in docs])
    docs = [r for r in docs if groups[r[0]][2]]
    leaked = {d for d, *_ in brute.contained([r[:2] for r in docs], items)}
    docs = [r for r in docs if r[0] not in leaked]
    assert leaked
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == {r[0] for r in docs}
    check_packing(out, [r[:2] for r in docs])


def test_stages_with_odd_rows(spark, odd, empty):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns, name
        kept = sorted((r["doc_id"] for r in out.collect()), key=str)
        want = {"language_id": [1, 2, 6, 7, 7, 9, 10, None], "line_dedup": sorted((r[0] for r in ODD), key=str),
                "minhash_near_dedup": [1, 3, 4, 5, 6, 8, 9, None], "benchmark_decontamination": sorted((r[0] for r in ODD), key=str)}
        assert kept == sorted(want[name], key=str), name
        assert stage(spark, empty, SF).select(columns).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0


def test_near_dedup_stage_loses_no_text_of_a_repeated_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (7, b), (8, c), (8, c), (9, c.upper()), (10, ""), (10, None), (10, ""), (None, a), (None, a)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = corpus_pipeline.minhash_near_dedup(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted((tuple(r)[:2] for r in out.collect()), key=str)
    assert sorted(t for d, t in got if d is not None and t) == [a, b, c]  # one row for each of the three texts
    assert (1, a) in got and (8, c) in got and sum(r == (None, a) for r in got) == 2
    assert sorted((t for d, t in got if d == 10), key=str) == ["", None]


def test_language_stage_rejects_other_languages(spark, documents):
    """Foreign, gibberish and letterless texts go, also long ones; short clean texts and whole tables stay."""
    frame, rows = documents
    foreign = ["Сегодня прекрасная погода, и мы пойдем с детьми на море, чтобы купаться и есть мороженое на солнце.",
               "今天天气很好我们和孩子们一起去海边游泳吃冰淇淋", "xqzv kjwpq zzxkq vbnmq wqxz jkqpz qqxv zxcvb kwjqz pqxzk vvkqj xzqwk jqzxv",
               "Dzisiaj jest piękna pogoda i pójdziemy z dziećmi nad morze, żeby popływać i zjeść lody w słońcu razem z przyjaciółmi.",
               "La vita è bella e il cielo sopra Roma è sereno; domani andremo al mare con gli amici per mangiare il pesce fresco "
               "e bere un bicchiere di vino bianco."]
    added = [t * n for t in foreign for n in (1, 30)] + ["12 34", "", None]
    short = ["That it.", "Reorea. Nd.", "Des enberge die enver.", "La aitreré èéle, éauxè et."]
    more = spark.createDataFrame([(10 ** 9 + i, t) for i, t in enumerate(added + short)], "doc_id bigint, text string")
    out = corpus_pipeline.language_id(spark, frame.unionByName(more, allowMissingColumns=True), SF)
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted(
        [d for d, _ in rows] + [10 ** 9 + len(added) + i for i in range(len(short))])
    bare = corpus_pipeline.language_id(spark, more.withColumn("lang", F.lit(None).cast("string")), SF)
    assert {r["doc_id"] - 10 ** 9 for r in bare.collect()} == {i for i, t in enumerate(added + short) if t not in ("12 34", "", None)}


def test_language_stage_tells_the_language_of_each_text(spark):
    """What is told goes on in lang, for texts without a label or with a wrong one, also of a language that only documents of one fold know."""
    words = {"xx": "wald baum haus wald", "yy": "foret arbre maison foret", "zz": "cizik yuvar kopek yuvar"}
    folds = [[i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == k] for k in range(5)]
    rows = [(i, words["xx"], "xx") for k in range(1, 5) for i in folds[k][:5]]
    rows += [(i, words["yy"], "yy") for k in range(1, 5) for i in folds[k][5:10]]
    rows += [(i, words["zz"], "zz") for i in folds[0][:20]]
    odd = [(1000, words["xx"], None), (1001, words["yy"], "xx"), (1002, words["zz"], None)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows + odd], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = corpus_pipeline.language_id(spark, docs, SF)
    assert out.schema == docs.schema
    got = {r["doc_id"]: r["lang"] for r in out.collect()}
    assert got == {**{r[0]: r[2] for r in rows}, 1000: "xx", 1001: "yy", 1002: "zz"}
    bare = corpus_pipeline.language_id(spark, docs.withColumn("lang", F.lit(None).cast("string")), SF)
    assert {r["lang"] for r in bare.collect()} == {None} and bare.count() == docs.count()


def test_floors_of_counted_scores(monkeypatch):
    """Scores that are counted give the floors of the same scores one by one, and texts counted in parts the same counts."""
    from rodovia.llm import language_id

    one = [("x", 600, 0.7), ("x", 600, 0.7), ("x", 40, 0.5), ("y", 600, 0.8), ("y", 600, 0.8), ("y", 600, 0.8)]
    want, got = language_id.floors_of(one), language_id.floors_of(sorted(set(one)), [1, 2, 3])
    assert want.keys() == got.keys() and all(np.allclose(want[k], got[k]) for k in want)
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y", "x"]), pa.array(["ab ba", "c", "ab"])], ["lang", "text"])

    def counts():
        total = collections.Counter()
        for b in language_id._count_by_language(iter([batch])):
            for r in b.to_pylist():
                total[r["lang"], r["gram"]] += r["n"]
        return total

    whole = counts()
    monkeypatch.setattr(language_id, "_HELD", 3)
    assert counts() == whole
