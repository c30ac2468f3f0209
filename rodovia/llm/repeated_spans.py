"""Exact removal of byte strings that occur in an earlier document, by suffix arrays.

All strings of WINDOW bytes are dealt to shards by their anchor, the smallest hash among their ANCHOR-byte strings, so
equal strings meet whatever documents they come from. Neighbouring strings with the same anchor travel as one span;
a span is described by hashes until its bytes are needed:

1. each scan task packs (anchor, span hash, document, place) into one block per shard;
2. a shard sorts its spans: equal spans are covered wherever they are not in their first document; spans whose
   anchor has one span only are done; the first spans of all other anchors need their bytes;
3. the bytes of these are cut into shards of bounded size. A shard gets its suffix array by Larsson-Sadakane
   refinement (sort by eight bytes, then double the depth of groups that are not yet apart), common prefixes of
   neighbours in Kasai's text order, and from runs with at least WINDOW common bytes the first document of every
   string. An anchor with more spans than a shard holds fills several shards; each pair of these is merged by
   binary search of one's strings in the other's sorted strings;
4. covered places of a document are united and cut out of its bytes.

A span that many documents of one scan task share (a hot passage) sends one row with the smallest document to its
shard; its places are spread by document and looked up afterwards with a join that may be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from rodovia.llm.shingles import mix64, text_slices
from rodovia.llm.tables import release, sorted_groups, stored

WINDOW, ANCHOR = 50, 20
SHARD_BYTES = 12 << 20    # of text whose spans one shard of step 2 gets
TASK_SHARDS = 2           # that a task gets on average, one after the other
FLUSH_BYTES = 12 << 20    # of text whose spans a scan task holds at once
SHARD_SPANS = 8192        # spans in a shard of step 3
HOT = 64                  # rows of one span in a scan batch from which it counts as hot
_CHUNK = 1 << 16           # bytes of text hashed at once: some twenty arrays of eight bytes each a byte are held meanwhile
_ROWS = 512                # texts, or 128 times as many spans, that go back to Spark in one batch
_BLOCK_BYTES = 1 << 20     # of blocks of spans from which they go back as a batch
_NEXT = WINDOW - ANCHOR + 1
_U = np.uint64
_PLACE = _U((1 << 21) - 1)  # room for a place in a chunk
_RNG = np.random.default_rng(20240502)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_P = int(_RNG.integers(1, 1 << 62)) * 2 + 1
#: Of a span hash 48 bits travel; they tell spans apart whose anchor hashes are equal.
_FP = _U((1 << 48) - 1)
_FIELDS = (("h", np.uint32), ("fp", np.uint64), ("doc", np.int64), ("row", np.int64), ("at", np.int32), ("n", np.uint8), ("hot", np.uint8))
_DELTAS = ("doc", "row", "at")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _spans(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, power: np.ndarray, inverse: np.ndarray) -> tuple:
    """Anchor hash, span hash, first string's start and number of strings, for texts at begin..end of ``raw``."""
    n = len(raw)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:n], out=total[1:])
    gram = mix64((total[ANCHOR:] - total[:-ANCHOR]) * inverse[:n - ANCHOR + 1])
    # Sliding minimum of (hash, place): of equal hashes the first wins, whatever stands around the string.
    low = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    step = 1
    while step * 2 <= _NEXT:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < _NEXT:
        low = np.minimum(low[:-(_NEXT - step)], low[_NEXT - step:])
    anchor = (low & _PLACE).astype(np.int64)
    inside = np.zeros(len(anchor) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, np.minimum(end - WINDOW + 1, len(anchor)), -1)
    starts = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
    if len(starts) == 0:
        return (np.zeros(0, np.int64),) * 4
    mine = anchor[starts]
    first = np.ones(len(starts), bool)
    first[1:] = (mine[1:] != mine[:-1]) | (starts[1:] != starts[:-1] + 1)
    text = np.searchsorted(begin, starts, "right")
    first[1:] |= text[1:] != text[:-1]
    head = np.flatnonzero(first)
    count = np.diff(np.append(head, len(starts)))
    at = starts[head]
    whole = (total[at + count - 1 + WINDOW] - total[at]) * inverse[at]
    return gram[mine[head]], mix64(whole + count.astype(np.uint64) * _U(0x9E3779B97F4A7C15)), at, count


def _packed(rows: dict[str, np.ndarray]) -> bytes:
    """A block: the number of its spans, and their fields compressed."""
    parts = []
    for name, kind in _FIELDS:
        v = rows[name].astype(kind)
        if name == "fp":
            parts += [v.astype(np.uint32).tobytes(), (v >> _U(32)).astype(np.uint16).tobytes()]
        else:
            parts.append((np.diff(v, prepend=v.dtype.type(0)) if name in _DELTAS else v).tobytes())
    return len(rows["h"]).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(blocks: list[bytes]) -> dict[str, np.ndarray]:
    """The fields of all spans; one block after the other is opened into its place in them."""
    sizes = [int.from_bytes(b[:4], "little") for b in blocks]
    out = {name: np.empty(sum(sizes), kind) for name, kind in _FIELDS}
    open_, begin = zstandard.ZstdDecompressor(), 0
    for block, n in zip(blocks, sizes):
        data, at = open_.decompress(memoryview(block)[4:]), 0
        for name, kind in _FIELDS:
            own = out[name][begin:begin + n]
            if name == "fp":
                own[:] = np.frombuffer(data, np.uint16, n, at + 4 * n)
                own <<= _U(32)
                own |= np.frombuffer(data, np.uint32, n, at)
                at += 6 * n
                continue
            v = np.frombuffer(data, kind, n, at)
            if name in _DELTAS:
                np.cumsum(v, dtype=kind, out=own)
            else:
                own[:] = v
            at += v.nbytes
        begin += n
    return out


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, row, text) with each text compressed by itself: texts are dealt out twice."""
    press = zstandard.ZstdCompressor(level=1)
    for whole in batches:
        for lo in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(lo, _ROWS)
            texts = [None if t is None else press.compress(t.encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], ["doc", "row", "text"])


def _scan(shards: int) -> Callable:
    """Step 1: one block of spans per shard and FLUSH_BYTES of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power, inverse = _powers(_P, _CHUNK * 3 + WINDOW), _powers(pow(_P, -1, 1 << 64), _CHUNK * 3 + WINDOW)
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found: list[tuple] = []
            held = 0
            for row, raw, offs in text_slices(batch.column(2), _CHUNK):
                # A long text goes in chunks that overlap by all but one byte of a string.
                for lo in range(0, max(len(raw), 1), 2 * _CHUNK):
                    part = raw[lo:lo + 2 * _CHUNK + WINDOW - 1]
                    if len(part) < WINDOW:
                        continue
                    begin = np.clip(offs[:-1] - lo, 0, len(part))
                    end = np.clip(offs[1:] - lo, 0, len(part))
                    long = end - begin >= WINDOW
                    if not long.any():
                        continue
                    h, fp, at, count = _spans(part, begin[long], end[long], power, inverse)
                    which = np.flatnonzero(long)[np.searchsorted(begin[long], at, "right") - 1]
                    found.append((h, fp & _FP, (row + which).astype(np.int32), (at + lo - offs[which]).astype(np.int32), count.astype(np.uint8)))
                    held += len(part)
                    if held >= FLUSH_BYTES:
                        yield from _dealt(found, shards, ids, keys)
                        held = 0
            if found:
                yield from _dealt(found, shards, ids, keys)
    return run


def _dealt(found: list[tuple], shards: int, ids: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The spans found so far, which are taken off the list, as one block per shard; of a hot span one row more, with its smallest
    document. A span's text is a row of the batch, whose documents and keys are ``ids`` and ``keys``."""
    columns = [list(x) for x in zip(*found)]
    found.clear()
    # Column by column: the pieces of one go before those of the next are put together.
    h, fp, text, at, n = (np.concatenate(columns.pop(0)) for _ in range(len(columns)))
    order = np.argsort(fp, kind="stable").astype(np.int32)
    edge = np.ones(len(fp), bool)
    sorted_fp = fp[order]
    np.not_equal(sorted_fp[1:], sorted_fp[:-1], out=edge[1:])
    del sorted_fp
    edge = np.flatnonzero(edge)
    size = np.diff(np.append(edge, len(order)))
    hot = np.zeros(len(h), np.uint8)
    summary = []
    for g in np.flatnonzero(size >= HOT):
        rows = order[edge[g]:edge[g] + size[g]]
        hot[rows] = 2
        summary.append(rows[np.argmin(ids[text[rows]])])
    del order, edge, size
    shard = (h % _U(shards)).astype(np.int32)
    places = np.flatnonzero(hot == 2)
    # Summaries come behind the spans, as numbers of theirs.
    summary = np.array(summary, np.int64)
    span = np.concatenate([np.arange(len(h), dtype=np.int32), summary.astype(np.int32)])
    shard = np.concatenate([shard, shard[summary]])
    shard[places] = mix64(ids[text[places]].astype(np.uint64)) % _U(shards)
    hot = np.concatenate([hot, np.ones(len(summary), np.uint8)])
    order = np.argsort(shard, kind="stable").astype(np.int32)
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    del shard, places
    own, blocks, held = [], [], 0
    for s in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
        rows = order[cut[s]:cut[s + 1]]
        pick = span[rows]
        blocks.append(_packed({"h": h[pick] >> _U(32), "fp": fp[pick], "doc": ids[text[pick]], "row": keys[text[pick]], "at": at[pick], "n": n[pick],
                               "hot": hot[rows]}))
        own.append(s)
        held += len(blocks[-1])
        if held >= _BLOCK_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(blocks, pa.binary())], ["shard", "spans"])
            own, blocks, held = [], [], 0
    if own:
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(blocks, pa.binary())], ["shard", "spans"])


_OUT = "kind int, h bigint, fp bigint, doc bigint, row bigint, at bigint, n int"


def _emit(kind: int, rows: dict[str, np.ndarray], picked: np.ndarray) -> Iterator[pa.RecordBatch]:
    # In order of document and place, which files compress well; of covered spans no hash is asked any more.
    picked = picked[np.lexsort((rows["at"][picked], rows["row"][picked], rows["doc"][picked]))]
    for lo in range(0, len(picked), 128 * _ROWS):
        pick = picked[lo:lo + 128 * _ROWS]
        h, fp = (np.zeros(len(pick), np.int64) if kind == COVERED else rows[k][pick].astype(np.int64) for k in ("h", "fp"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(pick), kind, np.int32)), pa.array(h), pa.array(fp), pa.array(rows["doc"][pick]), pa.array(rows["row"][pick]),
             pa.array(rows["at"][pick].astype(np.int64)), pa.array(rows["n"][pick].astype(np.int32))], ["kind", "h", "fp", "doc", "row", "at", "n"])


COVERED, FIRST, PLACE, ANSWER = 0, 1, 2, 3


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: covered spans, spans whose bytes are needed, places of hot spans, and hot spans' first documents."""
    for group in sorted_groups(batches, ["shard"]):
        rows = _unpacked(group.column("spans").to_pylist())
        del group
        place = np.flatnonzero(rows["hot"] == 2)
        if len(place):
            yield from _emit(PLACE, rows, place)
        main = np.flatnonzero(rows["hot"] != 2).astype(np.int32)
        if len(main) == 0:
            continue
        order = main[np.lexsort((rows["doc"][main], rows["fp"][main], rows["h"][main]))]
        del place, main
        new_h, new_span = np.ones(len(order), bool), np.ones(len(order), bool)
        v = rows["h"][order]
        np.not_equal(v[1:], v[:-1], out=new_h[1:])
        v = rows["fp"][order]
        np.not_equal(v[1:], v[:-1], out=new_span[1:])
        new_span |= new_h
        number = np.cumsum(new_span, dtype=np.int32) - np.int32(1)
        v = rows["doc"][order]
        later = v > v[new_span][number]
        del v
        summary = rows["hot"][order] == 1
        yield from _emit(COVERED, rows, order[later & ~summary])
        hot_span = np.zeros(int(number[-1]) + 1, bool)
        hot_span[number[summary]] = True
        if hot_span.any():
            yield from _emit(ANSWER, rows, order[new_span][hot_span])
        anchor = np.cumsum(new_h, dtype=np.int32) - np.int32(1)
        alone = (np.bincount(anchor[new_span]) == 1)[anchor]
        del anchor
        yield from _emit(FIRST, rows, order[~later & ~alone & ~summary])
        # Hot spans' first places come from their own rows; one row stands for the strings of the span.
        yield from _emit(FIRST, rows, order[new_span & hot_span[number] & ~alone & summary])


def _with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed spans of each document."""
    open_ = zstandard.ZstdDecompressor()
    for batch in batches:
        spans = batch.column(3)
        if isinstance(spans, pa.ChunkedArray):
            spans = spans.combine_chunks()
        edge = np.concatenate([[0], np.cumsum(spans.value_lengths().to_numpy())])
        flat = spans.flatten()
        at, n = flat.field("at").to_numpy(), flat.field("n").to_numpy()
        for lo in range(0, batch.num_rows, _ROWS):
            hi = min(lo + _ROWS, batch.num_rows)
            parts = []
            for i in range(lo, hi):
                raw = open_.decompress(batch.column(2)[i].as_py())
                parts += [raw[b:e] for b, e in zip(at[edge[i]:edge[i + 1]].tolist(),
                                                   (at[edge[i]:edge[i + 1]] + n[edge[i]:edge[i + 1]] + WINDOW - 1).tolist())]
            own = flat.slice(edge[lo], edge[hi] - edge[lo])
            owner = pa.array(np.repeat(np.arange(lo, hi), np.diff(edge[lo:hi + 1])))
            yield pa.RecordBatch.from_arrays(
                [own.field("h"), own.field("fp"), batch.column(0).take(owner), batch.column(1).take(owner), own.field("at"), own.field("n"),
                 pa.array(parts, pa.binary())], ["h", "fp", "doc", "row", "at", "n", "bytes"])


def suffix_array(text: np.ndarray, depth: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` bytes (a power of two from 8), and their packed first eight bytes.

    Larsson and Sadakane's refinement: groups of equal ranks are sorted by the rank of what follows them, at twice
    the depth each time; a suffix that is alone in its group is never touched again.
    """
    n = len(text)
    place = np.int32 if n + depth < 1 << 31 else np.int64
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    packed = np.zeros(n, np.uint64)
    for j in range(8):
        packed <<= _U(8)
        packed |= padded[j:j + n]
    order = np.argsort(packed, kind="stable").astype(place)
    key = packed[order]
    edge = np.ones(n, bool)
    np.not_equal(key[1:], key[:-1], out=edge[1:])
    begin = np.flatnonzero(edge).astype(place)
    rank = np.empty(n + depth, place)
    rank[n:] = 0
    rank[order] = begin[np.cumsum(edge, dtype=place) - 1] + 1
    done = 8
    while done < depth:
        size = np.diff(np.append(begin, n))
        slots = np.flatnonzero(np.repeat(size > 1, size)).astype(place)
        if len(slots) == 0:
            break
        own = order[slots]
        key = rank[own].astype(np.uint64)
        key <<= _U(32)
        key |= rank[own + done].astype(np.uint64)
        by = np.argsort(key, kind="stable")
        order[slots] = own[by]
        key = key[by]
        del own, by
        split = np.concatenate([[True], key[1:] != key[:-1]])
        edge[slots] |= split
        begin = np.flatnonzero(edge).astype(place)
        rank[order] = begin[np.cumsum(edge, dtype=place) - 1] + 1
        done *= 2
    return order, packed


def common_prefixes(order: np.ndarray, packed: np.ndarray, depth: int = 64) -> np.ndarray:
    """Common bytes (up to ``depth``) of each suffix with the one before it in order; 0 for the first.

    Kasai's rule: in text order a suffix shares at least one byte less with its neighbour than the suffix that starts a byte
    earlier shared with its own, so comparing goes on from there, eight bytes at a step. Suffixes that share ``depth`` bytes are
    in no order of what follows, so behind them comparing begins anew unless both neighbours just move on by a byte. The text is cut
    into chunks that are walked side by side.
    """
    n = len(order)
    before = np.full(n, -1, order.dtype)
    before[order[1:]] = order[:-1]
    common = np.zeros(n, np.uint8)
    size = max(1, int(n ** 0.5) // 4)
    place = np.arange(0, n, size)
    carried = np.zeros(len(place), np.int64)
    for _ in range(size):
        place, carried = place[place < n], carried[:np.count_nonzero(place < n)]
        other = before[place]
        carried = np.where(other >= 0, carried, 0)
        open_ = np.flatnonzero(other >= 0)
        while len(open_):
            i, j = place[open_] + carried[open_], other[open_] + carried[open_]
            fits = (i < n) & (j < n)
            open_, i, j = open_[fits], i[fits], j[fits]
            apart = packed[i] ^ packed[j]
            same = apart == 0
            # Equal leading bytes of the first eight that differ, by halving.
            lead = np.zeros(len(apart), np.int64)
            for half in (4, 2, 1):
                high = (apart >> _U(64 - 8 * half)) == 0
                lead[high] += half
                apart[high] <<= _U(8 * half)
            lead[same] = 8
            carried[open_] = np.minimum(carried[open_] + lead, depth)
            open_ = open_[same & (carried[open_] < depth)]
        # The end of the text is padded with zero bytes, which are no common ones.
        carried = np.minimum(carried, n - np.maximum(place, other))
        common[place] = carried
        following = before[np.minimum(place + 1, n - 1)]
        carried = np.where((carried < depth) | (following == other + 1), np.maximum(carried - 1, 0), 0)
        place = place + 1
    return common[order]


def _shard_strings(doc: np.ndarray, n: np.ndarray, texts: list[bytes], merged: bool) -> tuple:
    """Of a shard: (span, string) of its strings in sorted order, their class, each class's first document, and if the shard is
    to be ``merged`` the classes' strings."""
    text = np.frombuffer(b"".join(texts), np.uint8)
    length = np.array([len(t) for t in texts])
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    order, packed = suffix_array(text)
    group = np.cumsum(common_prefixes(order, packed) < WINDOW, dtype=order.dtype) - 1
    del packed
    span = np.full(len(text), -1, order.dtype)
    string = np.arange(int(n.sum()), dtype=order.dtype) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]).astype(order.dtype), n)
    owner = np.repeat(np.arange(len(n), dtype=order.dtype), n)
    span[begin[owner] + string] = owner
    del string, owner
    used = span[order] >= 0
    places, group = order[used], group[used]
    owner = span[places]
    edge = np.concatenate([[True], group[1:] != group[:-1]])
    group = np.cumsum(edge, dtype=order.dtype) - 1
    heads = np.flatnonzero(edge)
    first = np.minimum.reduceat(doc[owner], heads)
    strings = np.lib.stride_tricks.sliding_window_view(text, WINDOW)[places[heads]] if merged else None
    return owner, places - begin[owner], group, first, strings


def _covered_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3, per pair of shards: the stretches of spans that occur in an earlier document."""
    for group in sorted_groups(batches, ["bucket", "lo", "hi"]):
        doc, key, at, n = (group.column(c).to_numpy() for c in ("doc", "row", "at", "n"))
        part = group.column("mine").to_numpy()
        texts = [b.as_py() for b in group.column("bytes")]
        sides = []
        shards = np.unique(part)
        for p in shards:
            rows = np.flatnonzero(part == p)
            sides.append((rows, *_shard_strings(doc[rows], n[rows], [texts[r] for r in rows], len(shards) == 2)))
        del texts
        if len(sides) == 2:
            # Merge: find one shard's distinct strings among the other's by binary search.
            (_, _, _, _, first_a, full_a), (_, _, _, _, first_b, full_b) = sides
            keys_a, keys_b = (np.ascontiguousarray(x).view(f"S{WINDOW}").ravel() for x in (full_a, full_b))
            where = np.minimum(np.searchsorted(keys_a, keys_b), len(keys_a) - 1)
            same = (full_a[where] == full_b).all(axis=1)
            low = np.minimum(first_a[where[same]], first_b[same])
            np.minimum.at(first_a, where[same], low)
            first_b[same] = low
        for rows, owner, string, cls, first, _ in sides:
            late = first[cls] < doc[rows][owner]
            span, place = rows[owner[late]], string[late]
            if len(span) == 0:
                continue
            o = np.lexsort((place, span))
            span, place = span[o], place[o]
            head = np.flatnonzero(np.concatenate([[True], (span[1:] != span[:-1]) | (place[1:] != place[:-1] + 1)]))
            count = np.diff(np.append(head, len(span)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[span[head]]), pa.array(key[span[head]]), pa.array(at[span[head]] + place[head]),
                 pa.array(count.astype(np.int32))], ["doc", "row", "at", "n"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4."""
    open_ = zstandard.ZstdDecompressor()
    for batch in batches:
        places = batch.column(2)
        if isinstance(places, pa.ChunkedArray):
            places = places.combine_chunks()
        edge = np.concatenate([[0], np.cumsum(places.value_lengths().fill_null(0).to_numpy())])
        flat = places.flatten()
        at, n = flat.field("at").to_numpy(), flat.field("n").to_numpy()
        for lo in range(0, batch.num_rows, _ROWS):
            hi = min(lo + _ROWS, batch.num_rows)
            out = []
            for i in range(lo, hi):
                text = batch.column(1)[i]
                raw = b"" if not text.is_valid else open_.decompress(text.as_py())
                begin, end = at[edge[i]:edge[i + 1]], at[edge[i]:edge[i + 1]] + n[edge[i]:edge[i + 1]] + WINDOW - 1
                order = np.argsort(begin, kind="stable")
                begin, reach = begin[order], np.maximum.accumulate(end[order])
                # Runs of places that touch or overlap.
                head = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]])) if len(begin) else np.zeros(0, np.int64)
                lows, highs = begin[head], reach[np.append(head[1:], len(begin)) - 1] if len(head) else reach
                kept = b"".join(raw[b:e] for b, e in zip([0, *highs.tolist()], [*lows.tolist(), len(raw)]))
                out.append((len(raw), int((highs - lows).sum()), len(head), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *[pa.array(c, k) for c, k in zip(zip(*out), kinds)]],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``docs``.

    A byte of the UTF-8 text goes if a 50-byte string that covers it also starts in a document with a smaller doc_id;
    strings never cross documents and are judged on the input. A null text has no bytes. A row without doc_id loses nothing
    and is nobody's earlier document. Rows that repeat a doc_id are judged each by its own text and lose nothing to each
    other. Other columns are ignored. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.xxhash64(F.col(text).cast("string")).alias("row"),
                       F.col(text).cast("string").alias("text"))
    named = docs.filter(f"doc is not null and octet_length(text) >= {WINDOW}")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    blocks = named.mapInArrow(_scan(shards), "shard int, spans binary").repartition(-(-shards // TASK_SHARDS), "shard")
    settled = stored(blocks.sortWithinPartitions("shard").mapInArrow(_settle, _OUT), "spans")
    release(spark)
    pressed = docs.mapInArrow(_compressed, "doc bigint, row bigint, text binary")
    span = ["doc", "row", "at", "n"]
    hot = (settled.filter(F.col("kind") == PLACE)
           .join(settled.filter(F.col("kind") == ANSWER).groupBy("h", "fp").agg(F.min("doc").alias("low")), ["h", "fp"]))
    covered = settled.filter(F.col("kind") == COVERED).select(span).unionByName(hot.filter("doc > low").select(span))
    first = (settled.filter(F.col("kind") == FIRST).select("h", "fp", *span)
             .unionByName(hot.filter("doc = low").select("h", "fp", *span)).distinct())
    asked = first.groupBy("doc", "row").agg(F.collect_list(F.struct("h", "fp", "at", "n")).alias("spans"))
    # Rows that repeat an id and text give their spans once.
    loaded = stored(pressed.join(asked.hint("merge"), ["doc", "row"]).dropDuplicates(["doc", "row"]).select("doc", "row", "text", "spans")
                    .mapInArrow(_with_bytes, "h bigint, fp bigint, doc bigint, row bigint, at bigint, n int, bytes binary"), "span_bytes")
    release(spark)
    buckets = max(1, -(-loaded.count() // SHARD_SPANS))
    loaded = loaded.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    sizes = loaded.groupBy("bucket").agg(F.count("*").alias("size"))
    parts = F.greatest(F.lit(1), F.round(F.col("size") / (2 * SHARD_SPANS)).cast("int"))
    dealt = (loaded.join(sizes, "bucket").withColumn("parts", parts)
             .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")))
    keys = ["bucket", "lo", "hi"]
    found = stored(dealt.select(*keys, "mine", *span, "bytes").repartition(*keys).sortWithinPartitions(*keys)
                   .mapInArrow(_covered_strings, "doc bigint, row bigint, at bigint, n int"), "covered")
    release(spark)
    places = covered.unionByName(found).groupBy("doc", "row").agg(F.collect_set(F.struct("at", "n")).alias("places"))
    return pressed.join(places.hint("merge"), ["doc", "row"], "left").select("doc", "text", "places").mapInArrow(
        _cut_out, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
