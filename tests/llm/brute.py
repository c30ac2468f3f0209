"""Plain versions of the operators for small tables."""

import collections
import hashlib
import re

UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near(rows):
    """doc_id -> (n_shingles, component, kept) for unique ids."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 3 * max(len(x), len(y)) <= 4 * min(len(x), len(y)):
                if 100 * len(x & y) >= 75 * len(x | y) and find(a) != find(b):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def contained(docs, items):
    """Sorted (doc_id, item_id, n_shingles, n_common)."""
    out = []
    for d, t in docs:
        x = shingles(t)
        for i, u in items:
            q = shingles(u)
            if q and 100 * len(q & x) >= 75 * len(q):
                out.append((d, i, len(q), len(q & x)))
    return sorted(out, key=str)


def repeats(rows, window=50):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256)."""
    first = {}
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (t or "").encode()
        for i in range(len(raw) - window + 1):
            first.setdefault(raw[i:i + window], d)
    out = {}
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if d is not None and first[raw[i:i + window]] < d:
                gone[i:i + window] = b"\1" * window
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def licenses(text, templates):
    """license -> merged (first word, end) of stretches that hold three quarters of a template, from every start place."""
    def cut(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(UPPER))
        return w, [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])

    w, seq = cut(text)
    out = {}
    for name, texts in templates.items():
        spans = []
        for template in texts:
            want = set(cut(template)[1])
            if not want & set(seq):
                continue
            for lo in range(len(seq)):
                part = [(i, s) for i, s in enumerate(seq[lo:lo + 4 * len(want)], lo) if s in want]
                if part and 100 * len({s for _, s in part}) >= 75 * len(want):
                    spans.append((part[0][0], min(part[-1][0] + 5, len(w))))
        merged = []
        for b, e in sorted(spans):
            if merged and b < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(merged[-1][1], e))
            else:
                merged.append((b, e))
        if merged:
            out[name] = merged
    return out


def site_lines(rows, ratio=0.05, least=3):
    """Kept text of (source, text) rows in order."""
    pages, count = collections.Counter(), collections.Counter()
    for source, text in rows:
        if source is not None:
            pages[source] += 1
            count.update({(source, x.strip(" ")) for x in (text or "").split("\n") if x.strip(" ")})

    def stays(source, line):
        n = count[source, line.strip(" ")]
        return source is None or not line.strip(" ") or n < least or n <= ratio * pages[source]

    return [None if t is None else "\n".join(x for x in t.split("\n") if stays(s, x)) for s, t in rows]
