"""Spelling variants of words one edit apart, found by a relational trie frontier.

The frequent words form a trie, kept as a distributed table of edges between prefixes. States (word, node, rest) say that an edit
has been made and that the rest of the word must follow below the node. Level by level all states are joined with the edges: a
state follows the next letter of its rest, while the words themselves walk down their own path and branch off into states that
skip a letter, or enter another child in place of the next letter. A state without rest at the node of a word has found a
neighbour; words with a letter more are found from the other side.

Near the root a trie is dense, and every branch would survive for long. One edit leaves either the first or the second half of a
word as it is, so there are two tries, of the words and of the reversed words, and branching begins in the middle, where tries are
sparse. A trie level is a round of joins, so words of LONG letters and more meet otherwise: by hashes of all strings that lack one
of their letters, confirmed on the words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rodovia.llm.shingles import mix64
from rodovia.llm.tables import stored
from rodovia.llm.word_hashes import Splitter

LEAST_LETTERS, LEAST_N, FACTOR = 6, 5, 5
DROP_EVERY = 199           # one of so many runs of a document loses a letter
LONG = 48                  # letters
COUNTED = 1 << 18          # distinct words that a task counts before it passes them on
HASHES = 1 << 18           # hashes of long words in a batch

# Runs hold no other byte below 0x80 than letters, so texts may be cut at any of them.
_CUT = Splitter(np.array([b < 0x80 and not chr(b).isalpha() for b in range(256)]), lower=True, seed=20240701)
#: a-z and U+00C0 to U+00FF as UTF-8, after A-Z are lower-cased.
_RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")


def _count_words(least_letters: int, drop_every: int) -> Callable:
    """(word, n): runs of letters; of every document one run in ``drop_every`` without one of its letters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            words = [(w.decode(), n) for w, n in total.items() if n]
            words = [(w, n) for w, n in words if len(w) >= least_letters]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())], ["word", "n"])

        for batch in batches:
            ids = batch.column(0)
            for row, raw, offs in _CUT.slices(batch.column(1)):
                for i in range(len(offs) - 1):
                    own = Counter(_RUN.findall(raw[offs[i]:offs[i + 1]].tobytes().lower()))
                    if not own:
                        continue
                    known = ids[row + i].as_py()
                    prefix = zlib.crc32(b":" if known is None else f"{known}:".encode())
                    for w in [w for w in own if zlib.crc32(w, prefix) % drop_every == 0]:
                        letters = w.decode()
                        at = zlib.crc32(w, prefix) % len(letters)
                        # Negative zero-sum: the run as it stood goes, what is left of it comes.
                        total[w] -= own[w]
                        total[(letters[:at] + letters[at + 1:]).encode()] += own[w]
                    total.update(own)
                if len(total) > COUNTED:
                    yield counted()
                    total.clear()
        yield counted()
    return run


def _char(s: Column | str, place: int | Column) -> Column:
    return F.substring(s, F.lit(place) if isinstance(place, int) else place, F.lit(1))


def _after(s: Column | str, place: int | Column) -> Column:
    """The string from the letter ``place`` (from 1) on."""
    return F.substring(s, F.lit(place) if isinstance(place, int) else place, F.length(s))


def _frontier(words: DataFrame, least_letters: int) -> DataFrame:
    """(word, near) for all words (column ``word``) one edit apart."""
    length = F.length("word")
    # The first letter of a path tells its trie; ``from`` is where branching begins.
    paths = stored(words.select("word", F.explode(F.array(
        F.struct(F.concat(F.lit(">"), "word").alias("path"), F.floor(length / 2).cast("int").alias("from")),
        F.struct(F.concat(F.lit("<"), F.reverse("word")).alias("path"), F.ceil(length / 2).cast("int").alias("from")))).alias("x"))
        .select("word", "x.path", (F.col("x.from") + 1).alias("from"), F.length("x.path").alias("size")), "paths")
    depth = F.col("depth")
    edges = stored(paths.select("path", F.explode(F.sequence(F.lit(least_letters // 2 + 1), F.col("size") - 1)).alias("depth"))
                   .select(F.substring("path", F.lit(1), depth).alias("parent"), F.substring("path", F.lit(1), depth + 1).alias("child"))
                   .distinct(), "edges")
    most = paths.agg(F.max(F.col("size") - F.col("from"))).first()[0]
    levels: list[DataFrame] = []
    for level in range(0 if most is None else most + 2):
        at = F.col("from") + level
        own = (paths.filter(at <= F.col("size"))
               .select("word", F.substring("path", F.lit(1), at).alias("node"), _after("path", at + 1).alias("rest")))
        letter, follows = _char("rest", 1), _after("rest", 2)
        # One side of a pair is enough: the longer word skips a letter, of two equally long ones that with the smaller letter
        # replaces it. Of equal letters in a row the last one is skipped.
        skipped = own.filter((F.col("rest") != "") & (letter != _char("rest", 2))).select("word", "node", follows.alias("rest"))
        replaced = (own.filter("rest <> ''").join(edges, own["node"] == edges["parent"]).filter(_char("child", F.length("child")) > letter)
                    .select("word", F.col("child").alias("node"), follows.alias("rest")))
        states = skipped.unionByName(replaced)
        if levels:
            moved = (levels[-1].filter("rest <> ''").select("word", F.concat("node", letter).alias("child"), follows.alias("rest"))
                     .join(edges.select("child"), "child").select("word", F.col("child").alias("node"), "rest"))
            states = states.unionByName(moved)
        levels.append(stored(states, "level"))
    if not levels:
        return words.select("word", F.col("word").alias("near")).limit(0)
    found = reduce(DataFrame.unionByName, [x.filter("rest = ''").select("word", F.col("node").alias("path")) for x in levels])
    pairs = found.join(paths.select("path", F.col("word").alias("near")), "path").select("word", "near").distinct()
    return _both_ways(pairs, "word", "near")


def _both_ways(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.explode(F.array(F.struct(F.col(a).alias("word"), F.col(b).alias("near")),
                                          F.struct(F.col(b).alias("word"), F.col(a).alias("near")))).alias("p")).select("p.*")


def _lacking_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, place, hash): of every word as a whole (place -1), and without the letter at each place."""
    base = 0x9E3779B97F4A7C15
    for batch in batches:
        for key, word in zip(batch.column(0).to_pylist(), batch.column(1)):
            code = np.frombuffer(word.as_py().encode("utf-32-le"), np.uint32).astype(np.uint64)
            code = mix64(code + np.uint64(1))
            power = np.full(len(code) + 1, base, np.uint64)
            power[0] = 1
            np.multiply.accumulate(power, out=power)
            before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * power[:-1])])
            # What follows the lacking letter moves one place to the front.
            after = np.concatenate([np.cumsum((code[1:] * power[:len(code) - 1])[::-1])[::-1], np.zeros(1, np.uint64)])
            for lo in range(-1, len(code), HASHES):
                place = np.arange(lo, min(lo + HASHES, len(code)))
                cut = np.maximum(place, 0)
                hashed = mix64(np.where(place < 0, before[-1], before[cut] + after[cut]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), key)), pa.array(place), pa.array(hashed.view(np.int64))], ["id", "place", "hash"])


def _long_neighbours(words: DataFrame) -> DataFrame:
    """(word, near) for all words one edit apart, with as many rows in between as the words have letters."""
    named = words.select(F.xxhash64("word").alias("id"), "word")
    lacking = stored(named.mapInArrow(_lacking_one, "id bigint, place bigint, hash bigint"), "lacking")
    whole = lacking.filter("place = -1").select("hash", F.col("id").alias("a"))
    part = lacking.filter("place >= 0")
    longer = part.select("hash", F.col("id").alias("b")).distinct().join(whole, "hash").select("a", "b")
    replaced = (part.select("hash", "place", F.col("id").alias("a")).join(part.select("hash", "place", F.col("id").alias("b")), ["hash", "place"])
                .filter("a < b").select("a", "b"))
    pairs = longer.unionByName(replaced).distinct()
    pairs = (pairs.join(named.select(F.col("id").alias("a"), F.col("word").alias("x")), "a")
             .join(named.select(F.col("id").alias("b"), F.col("word").alias("y")), "b").filter(F.levenshtein("x", "y", 1) == 1))
    return _both_ways(pairs, "x", "y")


def neighbours(words: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(word, near) for all pairs, in both directions, of distinct words (column ``word``) that differ by exactly one letter
    inserted, deleted or replaced. Words have at least ``least_letters`` letters."""
    short = _frontier(words.filter(F.length("word") <= LONG), least_letters)
    return short.unionByName(_long_neighbours(words.filter(F.length("word") >= LONG))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead to. Each round doubles the steps; forms grow in frequency, so there is no circle."""
    ahead = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(ahead.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ahead = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return ahead


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
                      least_n: int = LEAST_N, factor: int = FACTOR, drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of at least ``least_letters`` letters and ``least_n`` occurrences.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased; of each document, runs whose CRC-32 with the doc_id is
    divisible by ``drop_every`` lose the letter at CRC modulo length. n_near counts the words one edit away; the form is
    the most frequent of them (ties: smallest by code points) if it is ``factor`` times as frequent, the root where forms lead
    to, the word itself without a form. A null text has no words; a null doc_id is written as nothing before the colon.
    Repeated rows count each. Other columns are ignored. An empty table gives an empty table.
    """
    counted = (docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("string"))
               .mapInArrow(_count_words(least_letters, drop_every), "word string, n bigint"))
    words = stored(counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n), "words")
    near = neighbours(words.select("word"), least_letters)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    summed = (near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
              .groupBy("word").agg(F.count("*").alias("n_near"), best))
    rows = words.join(summed, "word", "left")
    is_form = -F.col("best.less") >= factor * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
                              F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(rows.filter("form is not null"))
    return (rows.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
