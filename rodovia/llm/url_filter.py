"""URL rules by a cascade of Bloom filters, in DataFrame functions only.

Level 1 encodes the listed keys; level 2 the keys of the corpus that level 1 wrongly lets pass; level 3 the listed
keys that level 2 wrongly catches, and so on until no level errs on the complete universe of keys that the corpus
can ask for. For these keys membership is then exact, and it is tested in the scan, without a join: the filters are
literals. Level 1 has about log2(universe / listed) bits a key, so the false positives, and with them all later levels,
are about as many as the listed keys, whatever the size of the corpus. A list is cut into cascades of at most
LISTED keys each, which bounds every literal.

A rule is a host and a path: it fits that host and its subdomains when the url's path starts with the rule's. The keys
of a url are its host and parent domains, each with the starts of its path in the lengths that rules have.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame, functions as F

from rodovia.llm.tables import stored

LISTED = 4096
_WORD = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``hashes`` bits a key among ``words`` 64-bit words."""

    number: int
    hashes: int
    words: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        out = F.lit(True)
        for i in range(self.hashes):
            at = _position(key, self.number, i, len(self.words))
            word = F.get(table, F.shiftright(at, 6).cast("int"))
            out = out & (word.bitwiseAND(_bit(at)) != 0)
        return out


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % _WORD).cast("int"))


def _position(key: Column, level: int, i: int, words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level * 64 + i), key), F.lit(words * _WORD).cast("bigint"))


def _level(keys: DataFrame, number: int, bits_per_key: float) -> Level:
    """Build a filter of the column ``key``; the driver gets its words, whose number the caller has bounded."""
    n = keys.count()
    words = max(1, ceil(n * bits_per_key / _WORD))
    hashes = max(1, round(bits_per_key * log(2)))
    at = F.explode(F.array(*[_position(F.col("key"), number, i, words) for i in range(hashes)]))
    rows = (keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(_bit(F.col("at"))).alias("bits")).collect())
    table = [0] * words
    for r in rows:
        table[r["word"]] = r["bits"]
    return Level(number, hashes, tuple(table))


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Filters that tell the keys ``listed`` from all other keys of ``universe`` (both: a column key)."""
    listed = stored(listed.select("key").filter("key is not null").distinct(), "listed")
    n = listed.count()
    if n == 0:
        return []
    # An estimate does: it sets the first filter's size, not its correctness.
    everything = max(universe.agg(F.approx_count_distinct("key")).first()[0], n)
    levels = [_level(listed, 1, max(2.0, 1.44 * log2(everything / n + 1)))]
    encoded = listed
    wrong = stored(universe.filter(levels[0].holds(F.col("key"))).select("key").distinct()
                   .join(listed, "key", "left_anti"), "wrong")
    while not wrong.isEmpty():
        levels.append(_level(wrong, len(levels) + 1, 10.0))
        encoded, wrong = wrong, stored(encoded.filter(levels[-1].holds(F.col("key"))), "wrong")
    return levels


def member(levels: Sequence[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    out = F.lit(False)
    for level in reversed(levels):
        out = level.holds(key) & ~out
    return out if levels else F.lit(False)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    found = [F.coalesce(F.regexp_extract(url, _URL, i), F.lit("")) for i in (1, 2)]
    return F.translate(found[0], _UPPER, _LOWER), found[1]


def _keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    labels = F.split(host, r"\.", -1)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.array_distinct(F.array(*[F.substring(path, 1, n) for n in lengths]))
    return F.flatten(F.transform(domains, lambda d: F.transform(starts, lambda s: F.concat(d, s))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows and columns of ``pages`` with host, path, rule and verdict after them.

    ``rules`` has host, path and verdict; of the rules that fit a url the longest text (host and path) wins. A url that
    no rule fits is on no list: it gets the verdict ``default`` and no rule. A null url, or one without ``://``, has an
    empty host and path, which no rule fits. Rules with a null in host or path are ignored; of repeated rules the
    smallest verdict counts. Columns of ``pages`` with the same names as the new ones are replaced.
    """
    columns = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), host.alias("host"), path.alias("path"))
    listed = (rules.filter("host is not null and path is not null and host <> ''")
              .select(F.concat(F.translate("host", _UPPER, _LOWER), "path").alias("key"), F.length("path").alias("n"), "verdict")
              .groupBy("key").agg(F.min("n").alias("n"), F.min("verdict").alias("verdict")))
    listed = stored(listed, "rules")
    total = listed.count()
    blocks = -(-total // LISTED)
    best = F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    for b in range(blocks):
        block = listed.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b)
        own = block.collect()  # at most about LISTED rules
        if not own:
            continue
        keys = _keys(F.col("host"), F.col("path"), sorted({r["n"] for r in own}))
        levels = build_cascade(block, rows.select(F.explode(keys).alias("key")))
        verdicts = F.create_map(*[F.lit(x) for r in own for x in (r["key"], r["verdict"])])
        fits = F.filter(keys, lambda k: member(levels, k))
        found = F.array_max(F.transform(fits, lambda k: F.struct(
            F.length(k).alias("n"), k.alias("rule"), F.try_element_at(verdicts, k).alias("verdict"))))
        best = F.greatest(best, found) if b else found
    rows = rows.withColumn("_best", best)
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in columns], "host", "path",
                       F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
