"""Removal of words in passages that occur in an earlier document, by super-k-mer partitioning.

A window is WINDOW consecutive words of a document. Its minimiser is the smallest hash among its GRAM-word sequences, so equal
windows have equal minimisers wherever they stand. Consecutive windows that share a minimiser travel as one packed string (their
words, single blanks between them) to the bucket of that minimiser:

1. a scan task packs its super-k-mers, each distinct string once with the places where it occurs, into one compressed block per
   bucket;
2. in a bucket equal strings are one. Where a minimiser has several, their windows are sorted exactly: words are numbered, and the
   ranks of 2, 4, ... 32 words and then of the whole window follow from sorting pairs of ranks. A window's first document is the
   smallest one that holds it; in all others its words are covered;
3. covered words of a document are united and cut out.

What many rows share does not gather in one task. A string that is frequent within a scan task (a copied text) sends one row with
the smallest document to its bucket; its places are dealt by document and looked up afterwards by a join whose skewed partitions
Spark splits. A minimiser with very many different strings (a passage in ever new surroundings), as a sample of the documents
tells, is not used for buckets: its windows are counted one by one by a plain aggregation over 128-bit hashes. The sample only
chooses the way, both ways are complete.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rodovia.llm.shingles import mix64
from rodovia.llm.tables import sorted_groups, stored
from rodovia.llm.word_hashes import Splitter

WINDOW, GRAM = 50, 8       # words
BUCKET_BYTES = 4 << 20     # of text whose super-k-mers one bucket gets
TASK_BUCKETS = 4           # that a task gets on average, one after the other
FLUSH_BYTES = 8 << 20      # of text whose super-k-mers a scan task holds at once
COMMON = 64                # places of a string in a scan task from which they are looked up afterwards
SAMPLE = 16                # one of so many documents tells the minimisers with very many strings
VARIED = 4096              # strings of a minimiser, by that estimate, from which its windows go one by one
MOST_VARIED = 1 << 16      # such minimisers at most
SORTED_WORDS = 1 << 21     # words whose windows are sorted at once

_U = np.uint64
_PLACE = _U((1 << 21) - 1)
_WORDS = Splitter(np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)]), lower=False, seed=20240612)
_BASES = [int(x) * 2 + 1 for x in np.random.default_rng(20240613).integers(1, 1 << 62, 3)]
_FIELDS = {  # of a block: strings, places, common strings, places looked up afterwards
    "length": np.uint32, "minimiser": np.uint64,
    "string": np.uint32, "doc": np.int64, "row": np.int64, "at": np.int64,
    "c_string": np.uint32, "c_doc": np.int64, "c_k1": np.int64, "c_k2": np.int64,
    "p_kind": np.uint8, "p_k1": np.int64, "p_k2": np.int64, "p_doc": np.int64, "p_row": np.int64, "p_at": np.int64, "p_n": np.uint8,
}
_STRING = ("length", "minimiser")
_OF_STRING = ("string", "doc", "row", "at")
_COMMON = ("c_string", "c_doc", "c_k1", "c_k2")
_LATER = ("p_kind", "p_k1", "p_k2", "p_doc", "p_row", "p_at", "p_n")
COVERED, PLACE, WINDOWED, ANSWER = range(4)
_OUT = "kind int, k1 bigint, k2 bigint, doc bigint, row bigint, at bigint, n int"


class _Text:
    """Documents (or pieces of one) one after the other, with words, hashes and minimisers."""

    def __init__(self, units: list[tuple[int, int, list[bytes]]]):
        words = [w for _, _, own in units for w in own]
        self.blob = b" ".join(words)
        self.end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        self.begin = np.concatenate([[0], self.end[:-1] + 1])
        hashed, _ = _WORDS.words(np.frombuffer(self.blob, np.uint8), np.array([0, len(self.blob)]))
        self.sums, self.inverse = [], []
        for base in _BASES[:2]:
            power = np.full(len(hashed) + 1, base, np.uint64)
            power[0] = 1
            np.multiply.accumulate(power, out=power)
            back = np.full(len(hashed) + 1, pow(base, -1, 1 << 64), np.uint64)
            back[0] = 1
            self.inverse.append(np.multiply.accumulate(back))
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * power[:-1])]))
        sizes = np.array([len(own) for _, _, own in units])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        gram = np.zeros(max(len(hashed) - GRAM + 1, 0), np.uint64)
        for j in range(GRAM):
            gram *= _U(_BASES[2])
            gram += hashed[j:j + len(gram)]
        gram = mix64(gram)
        # Sliding minimum of (hash, place): of equal hashes the first wins, whatever stands around the window.
        low = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
        width, step = WINDOW - GRAM + 1, 1
        while step * 2 <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < width:
            low = np.minimum(low[:-(width - step)], low[width - step:])
        anchor = (low & _PLACE).astype(np.int64)
        full = np.flatnonzero(sizes >= WINDOW)
        unit = np.repeat(full, sizes[full] - WINDOW + 1)
        start = np.arange(len(unit)) - np.repeat(np.concatenate([[0], np.cumsum(sizes[full] - WINDOW + 1)[:-1]]), sizes[full] - WINDOW + 1)
        start += first[unit]
        mine = anchor[start]
        new = np.ones(len(start), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (unit[1:] != unit[:-1])
        head = np.flatnonzero(new)
        self.start, self.n = start[head], np.diff(np.append(head, len(start)))
        self.minimiser = gram[mine[head]]
        self.unit = unit[head]
        self.at = self.start - first[self.unit] + np.array([base for _, base, _ in units])[self.unit]
        self.index = np.array([row for row, _, _ in units])[self.unit]

    def keys(self, start: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        """128-bit hashes of ``n`` windows from word ``start`` on."""
        return [mix64((s[start + n + WINDOW - 1] - s[start]) * i[start] + n.astype(np.uint64)).view(np.int64)
                for s, i in zip(self.sums, self.inverse)]

    def strings(self, pick: np.ndarray) -> list[bytes]:
        blob = self.blob
        return [blob[b:e] for b, e in zip(self.begin[self.start[pick]].tolist(), self.end[self.start[pick] + self.n[pick] + WINDOW - 2].tolist())]


def _texts(column: pa.Array) -> Iterator[_Text]:
    """Slices of a text column; the pieces of a long text overlap by all but one word of a window."""
    last, words, seen = -1, [], 0
    for row, raw, offs in _WORDS.slices(column):
        units = []
        for i in range(len(offs) - 1):
            own = raw[offs[i]:offs[i + 1]].tobytes().split()
            base = 0
            if row + i == last:
                base = seen - len(words)
                seen += len(own)
                own = words + own
            else:
                last, seen = row + i, len(own)
            words = own[1 - WINDOW:]
            if len(own) >= WINDOW:
                units.append((row + i, base, own))
        if units:
            yield _Text(units)


def _minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(minimiser, string hash) of every super-k-mer."""
    for batch in batches:
        for t in _texts(batch.column(2)):
            yield pa.RecordBatch.from_arrays([pa.array(t.minimiser.view(np.int64)), pa.array(t.keys(t.start, t.n)[0])], ["minimiser", "string"])


def _packed(strings: list[bytes], rows: dict[str, np.ndarray]) -> bytes:
    parts = []
    for name, kind in _FIELDS.items():
        v = rows[name].astype(kind)
        parts += [len(v).to_bytes(4, "little"), v.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts + strings))


def _unpacked(block: bytes) -> tuple[list[bytes], dict[str, np.ndarray]]:
    data = zstandard.ZstdDecompressor().decompress(block)
    at, rows = 0, {}
    for name, kind in _FIELDS.items():
        n = int.from_bytes(data[at:at + 4], "little")
        rows[name] = np.frombuffer(data, kind, n, at + 4)
        at += 4 + rows[name].nbytes
    edge = np.concatenate([[0], np.cumsum(rows["length"], dtype=np.int64)]) + at
    return [data[b:e] for b, e in zip(edge[:-1].tolist(), edge[1:].tolist())], rows


def _scan(buckets: int, varied: np.ndarray) -> Callable:
    """Step 1: one block per bucket and flush."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        found: list[tuple] = []
        later: list[tuple] = []
        held = 0
        for batch in batches:
            doc, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for t in _texts(batch.column(2)):
                alone = np.isin(t.minimiser, varied)
                if alone.any():
                    own = np.flatnonzero(alone)
                    each = np.repeat(own, t.n[own])
                    place = np.arange(len(each)) - np.repeat(np.concatenate([[0], np.cumsum(t.n[own])[:-1]]), t.n[own])
                    one = np.ones(len(each), np.int64)
                    k1, k2 = t.keys(t.start[each] + place, one)
                    later.append((one * WINDOWED, k1, k2, doc[t.index[each]], row[t.index[each]], t.at[each] + place, one))
                own = np.flatnonzero(~alone)
                which = np.array([number.setdefault(s, len(number)) for s in t.strings(own)], np.int64)
                found.append((which, doc[t.index[own]], row[t.index[own]], t.at[own], t.n[own], t.minimiser[own], *t.keys(t.start[own], t.n[own])))
                held += len(t.blob)
                if held >= FLUSH_BYTES:
                    yield _dealt(list(number), found, later, buckets)
                    number, found, later, held = {}, [], [], 0
        if held:
            yield _dealt(list(number), found, later, buckets)
    return run


def _dealt(strings: list[bytes], found: list[tuple], later: list[tuple], buckets: int) -> pa.RecordBatch:
    """The super-k-mers found so far as one block per bucket."""
    which, doc, row, at, n, minimiser, k1, k2 = (np.concatenate(x) for x in zip(*found))
    _, example, places = np.unique(which, return_index=True, return_counts=True)
    bucket_of = (minimiser[example] % _U(buckets)).astype(np.int64)
    common = (places >= COMMON)[which]
    lowest = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(lowest, which, doc)
    c = np.flatnonzero(places >= COMMON)
    later = later + [(np.full(common.sum(), PLACE), k1[common], k2[common], doc[common], row[common], at[common], n[common])]
    rows = {
        "length": np.fromiter(map(len, strings), np.int64, len(strings)), "minimiser": minimiser[example],
        "string": which[~common], "doc": doc[~common], "row": row[~common], "at": at[~common],
        "c_string": c, "c_doc": lowest[c], "c_k1": k1[example[c]], "c_k2": k2[example[c]],
        **{name: np.concatenate(x) for name, x in zip(_LATER, zip(*later))},
    }
    dealt = {_STRING: bucket_of, _OF_STRING: bucket_of[rows["string"]], _COMMON: bucket_of[c],
             # These wait for the join that follows, each document's anywhere.
             _LATER: (mix64(rows["p_doc"].astype(np.uint64)) % _U(buckets)).astype(np.int64)}
    order = {names: np.argsort(b, kind="stable") for names, b in dealt.items()}
    cut = {names: np.searchsorted(b[order[names]], np.arange(buckets + 1)) for names, b in dealt.items()}
    place = np.empty(len(strings), np.int64)
    place[order[_STRING]] = np.arange(len(strings)) - cut[_STRING][bucket_of[order[_STRING]]]
    rows["string"], rows["c_string"] = place[rows["string"]], place[rows["c_string"]]
    own = [b for b in range(buckets) if any(x[b + 1] > x[b] for x in cut.values())]
    blocks = []
    for b in own:
        pick = {names: order[names][cut[names][b]:cut[names][b + 1]] for names in dealt}
        blocks.append(_packed([strings[s] for s in pick[_STRING].tolist()], {k: rows[k][pick[names]] for names in dealt for k in names}))
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(blocks, pa.binary())], ["bucket", "block"])


def _emit(kind: int, k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, row: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    kinds = np.full(len(doc), kind, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (kinds, k1, k2, doc, row, at.astype(np.int64), n.astype(np.int32))],
                                      ["kind", "k1", "k2", "doc", "row", "at", "n"])


def window_classes(strings: list[bytes]) -> np.ndarray:
    """A number for every window of the strings, one string after the other: equal ones for equal words."""
    words = b" ".join(strings).split(b" ")
    rank = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    sizes = np.array([s.count(b" ") + 1 for s in strings])
    ends = np.cumsum(sizes)
    step = 1
    while step * 2 <= WINDOW:  # ranks of twice as many words
        _, rank = np.unique(rank[:-step] * (rank.max() + 1) + rank[step:], return_inverse=True)
        step *= 2
    n = sizes - WINDOW + 1
    start = np.arange(int(n.sum())) + np.repeat(ends - sizes - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    return np.unique(rank[start] * (rank.max() + 1) + rank[start + WINDOW - step], return_inverse=True)[1]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: covered places, and for common strings the first documents of their windows."""
    for group in sorted_groups(batches, ["bucket"]):
        number: dict[bytes, int] = {}
        minimiser: list[np.ndarray] = []
        parts: list[dict[str, np.ndarray]] = []
        for block in group.column("block"):
            strings, rows = _unpacked(block.as_py())
            known = len(number)
            code = np.array([number.setdefault(s, len(number)) for s in strings], np.int64)
            new = np.flatnonzero(code >= known)
            minimiser.append(rows["minimiser"][new])
            if len(rows["p_doc"]):
                for kind in (PLACE, WINDOWED):
                    p = rows["p_kind"] == kind
                    yield _emit(kind, *(rows[x][p] for x in _LATER[1:]))
            parts.append({"string": code[rows["string"]], "c_string": code[rows["c_string"]],
                          **{k: rows[k] for k in ("doc", "row", "at", "c_doc", "c_k1", "c_k2")}})
        del group
        of = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        strings, minimiser = list(number), np.concatenate(minimiser)
        del number, parts
        if not strings:
            continue
        first = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(first, of["string"], of["doc"])
        np.minimum.at(first, of["c_string"], of["c_doc"])
        # A string that was common in several scan tasks is answered once.
        once = np.unique(of["c_string"], return_index=True)[1]
        of |= {k: of[k][once] for k in _COMMON}
        n = np.array([s.count(b" ") + 2 - WINDOW for s in strings])
        order = np.argsort(minimiser, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], minimiser[order][1:] != minimiser[order][:-1]]))
        several = np.diff(np.append(edge, len(order))) > 1
        alone = np.zeros(len(strings), bool)
        alone[order[edge[~several]]] = True
        late = alone[of["string"]] & (of["doc"] > first[of["string"]])
        zero = np.zeros(int(late.sum()), np.int64)
        yield _emit(COVERED, zero, zero, of["doc"][late], of["row"][late], of["at"][late], n[of["string"][late]])
        own = alone[of["c_string"]]
        s = of["c_string"][own]
        yield _emit(ANSWER, of["c_k1"][own], of["c_k2"][own], first[s], np.zeros(len(s), np.int64), np.zeros(len(s), np.int64), n[s])
        # Minimisers with several strings, some at a time.
        members = order[~alone[order]]
        if len(members) == 0:
            continue
        group_no = np.cumsum(np.concatenate([[True], minimiser[members][1:] != minimiser[members][:-1]])) - 1
        words_before = np.concatenate([[0], np.cumsum(n[members] + WINDOW - 1)[:-1]])
        at_group = words_before[np.flatnonzero(np.concatenate([[True], group_no[1:] != group_no[:-1]]))]
        chunk = (at_group // SORTED_WORDS)[group_no]
        place, c_place = _by_string(of["string"], len(strings)), _by_string(of["c_string"], len(strings))
        for c in np.unique(chunk):
            yield from _windows(members[chunk == c], strings, n, first, of, place, c_place)


def _by_string(string: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows ordered by their string, and where each string's begin."""
    order = np.argsort(string, kind="stable")
    return order, np.searchsorted(string[order], np.arange(size + 1))


def _spread(count: np.ndarray) -> np.ndarray:
    """0, 1, ... below each count."""
    return np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)


def _windows(pick: np.ndarray, strings: list[bytes], n: np.ndarray, first: np.ndarray, of: dict[str, np.ndarray],
             place: tuple, c_place: tuple) -> Iterator[pa.RecordBatch]:
    """Window by window: what is covered of the places of the strings ``pick``, and answers for the common ones."""
    cls = window_classes([strings[i] for i in pick.tolist()])
    lowest = np.full(int(cls.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, cls, np.repeat(first[pick], n[pick]))
    first_doc = lowest[cls]
    begin = np.zeros(len(strings), np.int64)
    begin[pick] = np.cumsum(n[pick]) - n[pick]
    order, edge = place
    rows = order[np.repeat(edge[pick], np.diff(edge)[pick]) + _spread(np.diff(edge)[pick])]
    s = of["string"][rows]
    each, j = np.repeat(np.arange(len(rows)), n[s]), _spread(n[s])
    late = first_doc[begin[s][each] + j] < of["doc"][rows][each]
    each, j = each[late], j[late]
    if len(each):
        head = np.flatnonzero(np.concatenate([[True], (each[1:] != each[:-1]) | (j[1:] != j[:-1] + 1)]))
        mine = rows[each[head]]
        zero = np.zeros(len(head), np.int64)
        yield _emit(COVERED, zero, zero, of["doc"][mine], of["row"][mine], of["at"][mine] + j[head], np.diff(np.append(head, len(each))))
    order, edge = c_place
    rows = order[np.repeat(edge[pick], np.diff(edge)[pick]) + _spread(np.diff(edge)[pick])]
    if len(rows):
        s = of["c_string"][rows]
        each, j = np.repeat(np.arange(len(rows)), n[s]), _spread(n[s])
        low = first_doc[begin[s][each] + j]
        head = np.flatnonzero(np.concatenate([[True], (each[1:] != each[:-1]) | (low[1:] != low[:-1])]))
        mine = rows[each[head]]
        yield _emit(ANSWER, of["c_k1"][mine], of["c_k2"][mine], low[head], np.zeros(len(head), np.int64), j[head], np.diff(np.append(head, len(each))))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3."""
    for batch in batches:
        places = batch.column(2)
        if isinstance(places, pa.ChunkedArray):
            places = places.combine_chunks()
        count = places.value_lengths().fill_null(0).to_numpy()
        edge = np.concatenate([[0], np.cumsum(count)])
        flat = places.flatten()
        at, n = flat.field("at").to_numpy(), flat.field("n").to_numpy()
        out = []
        for i, text in enumerate(batch.column(1)):
            words = (text.as_py() or "").encode().split()
            removed = 0
            kept = words
            if count[i]:
                change = np.zeros(len(words) + 1, np.int64)
                own = slice(edge[i], edge[i + 1])
                np.add.at(change, at[own], 1)
                np.add.at(change, at[own] + n[own] + WINDOW - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed = int(gone.sum())
                kept = [words[k] for k in np.flatnonzero(~gone)]
            kept = b" ".join(kept)
            out.append((len(words), removed, hashlib.sha256(kept).hexdigest(), kept))
        if out:
            n_words, n_removed, digest, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for every row of ``docs``; kept: the words that stay, single blanks between.

    A word goes if one of the windows over it has a word sequence that is also a window of a document with a smaller doc_id;
    windows are judged on the input. Words are runs of other bytes than blanks, unchanged. A null text has no words. A row without
    doc_id loses nothing and is nobody's earlier document. Rows that repeat a doc_id are judged each by its own text and take
    nothing from each other. Other columns are ignored. An empty table gives an empty table.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.xxhash64(F.col(text).cast("string")).alias("row"),
                       F.col(text).cast("string").alias("text"))
    named = docs.filter(f"doc is not null and octet_length(text) >= {2 * WINDOW - 1}")
    varied = (named.filter(F.pmod(F.xxhash64("doc", "row"), F.lit(SAMPLE)) == 0)
              .mapInArrow(_minimisers, "minimiser bigint, string bigint").distinct()
              .groupBy("minimiser").agg(F.count("*").alias("n")).filter(F.col("n") >= max(1, VARIED // SAMPLE))
              .orderBy(F.desc("n"), "minimiser").limit(MOST_VARIED).toArrow().column("minimiser").to_numpy().view(np.uint64))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    blocks = named.mapInArrow(_scan(buckets, varied), "bucket int, block binary").repartition(-(-buckets // TASK_BUCKETS), "bucket")
    settled = stored(blocks.sortWithinPartitions("bucket").mapInArrow(_settle, _OUT), "windows")

    def of(kind: int) -> DataFrame:
        return settled.filter(F.col("kind") == kind)

    place = ["doc", "row", "at", "n"]
    answers = of(ANSWER).select("k1", "k2", F.col("doc").alias("low"), F.col("at").alias("from"), F.col("n").alias("windows"))
    common = (of(PLACE).join(answers, ["k1", "k2"]).filter("doc > low")
              .select("doc", "row", (F.col("at") + F.col("from")).alias("at"), F.col("windows").alias("n")))
    lows = of(WINDOWED).groupBy("k1", "k2").agg(F.min("doc").alias("low"))
    single = of(WINDOWED).join(lows, ["k1", "k2"]).filter("doc > low").select(place)
    covered = of(COVERED).select(place).unionByName(common).unionByName(single)
    places = covered.groupBy("doc", "row").agg(F.collect_set(F.struct("at", "n")).alias("places"))
    return (docs.join(places.hint("merge"), ["doc", "row"], "left").select("doc", "text", "places").mapInArrow(
        _cut_out, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept binary"))
