"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit numbers make all coordinates of a signature: ``sigma`` scatters the shingles
once, ``pi`` ranks them, and coordinate k is the minimum of pi(sigma(x) + k), that is pi shifted circularly by
k. 128 coordinates are cut into 32 bands of four: at a similarity of 0.75 two sets share a band with probability
0.999995 (at 0.8 with 0.99999996). Every link is confirmed on the full sets.

Work on a bucket of the bands is cut into blocks, so no group has to fit into one task:

1. sets that are equal count as one (their smallest document stands for them);
2. a bucket is dealt into blocks at random, and in each (of up to eight blocks: in each pair of them) the strongest tree of estimated
   similarities proposes links; these are verified exactly and joined to components. Larger buckets that still hold several
   components are dealt anew, a few times: each round moves every member once, and a dense group, however large, becomes one
   component;
3. only buckets that still hold several components are looked at again: their members are compared exactly across
   components, as products of incidence matrices, and only spanning links are emitted. Members of a bucket's largest
   component meet the others, never each other.

A third of all documents in one bucket thus costs a few rounds of tree edges, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rodovia.llm.components import components
from rodovia.llm.shingles import intersection_size, mix64, shingle_sets
from rodovia.llm.tables import fixed_binary, release, sorted_groups, stored

COORDINATES, ROWS = 128, 4
BANDS = COORDINATES // ROWS
THRESHOLD = 75  # percent
#: Estimates below this many equal coordinates (of 128) are no candidates: five deviations below 0.75.
LEAST_EQUAL = int(COORDINATES * 0.75 - 5 * (COORDINATES * 0.75 * 0.25) ** 0.5)
BLOCK = 512
PAIRED = 8   # blocks of a bucket up to which all pairs of them are looked at; beyond it members are dealt anew instead
ROUNDS = 3
_CHUNK = 1 << 15
_U32 = np.uint32


def _permute(x: np.ndarray, t: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of the 32-bit numbers, in place; ``t`` is scratch space."""
    np.right_shift(x, _U32(16), out=t)
    x ^= t
    x *= _U32(a)
    np.right_shift(x, _U32(15), out=t)
    x ^= t
    x *= _U32(b)
    np.right_shift(x, _U32(16), out=t)
    x ^= t
    return x


def signature(hashes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The circulant MinHash signature of a non-empty set of 64-bit hashes."""
    out = np.full(coordinates, 0xFFFFFFFF, _U32)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i:i + _CHUNK]
        base = (part ^ (part >> np.uint64(32))).astype(_U32)
        base = _permute(base, np.empty_like(base), 0x7FEB352D, 0x846CA68B)  # sigma
        rows = max(1, _CHUNK // len(base))
        for k in range(0, coordinates, rows):
            shifts = np.arange(k, min(k + rows, coordinates), dtype=_U32)
            x = base[None, :] + shifts[:, None]
            _permute(x, np.empty_like(x), 0x21F0AAAD, 0xD35A2D97)  # pi, shifted
            np.minimum(out[k:k + rows], x.min(axis=1), out=out[k:k + rows])
    return out


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        n = batch.num_rows
        size, f1, f2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        sigs: list[bytes | None] = [None] * n
        bands: list[np.ndarray | None] = [None] * n
        for i, s in shingle_sets(batch.column(1)):
            size[i] = len(s)
            if len(s) == 0:
                continue
            f1[i], f2[i] = mix64(s ^ np.uint64(0x5BD1E995)).sum(), mix64(s + np.uint64(0x1B873593)).sum()
            g = signature(s)
            sigs[i] = g.astype(np.uint8).tobytes()
            quad = g.reshape(BANDS, ROWS).astype(np.uint64)
            key = salt.copy()
            for j in range(ROWS):
                key = mix64(key ^ quad[:, j])
            bands[i] = key.view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
             pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            ["id", "n", "f1", "f2", "sig", "bands"])


def _comparable(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can reach the threshold at all."""
    return 100 * np.minimum(a, b) >= THRESHOLD * np.maximum(a, b)


def _strongest_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group, the edges of a spanning forest of greatest estimated similarity."""
    for group in sorted_groups(batches, ["bucket", "lo", "hi"]):
        ids, size = group.column("id").to_numpy(), group.column("n").to_numpy()
        sig = fixed_binary(group.column("sig"), COORDINATES)
        order = np.argsort(ids, kind="stable")
        ids, size, sig = ids[order], size[order], sig[order]
        best = np.zeros(len(ids), np.int64)
        parent = np.full(len(ids), -1)
        open_ = np.ones(len(ids), bool)
        a, b = [], []
        for _ in range(len(ids)):
            v = int(np.argmax(np.where(open_, best, -1)))
            open_[v] = False
            if parent[v] >= 0:
                a.append(ids[parent[v]])
                b.append(ids[v])
            rest = np.flatnonzero(open_)
            if len(rest) == 0:
                break
            equal = np.count_nonzero(sig[rest] == sig[v], axis=1)
            better = (equal >= LEAST_EQUAL) & (equal > best[rest]) & _comparable(size[rest], size[v])
            best[rest[better]] = equal[better]
            parent[rest[better]] = v
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _undecided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group, the members that may be linked to a member of another component."""
    for group in sorted_groups(batches, ["bucket", "lo", "hi"]):
        size, label = group.column("n").to_numpy(), group.column("label").to_numpy()
        sig = fixed_binary(group.column("sig"), COORDINATES)
        keep = np.zeros(len(size), bool)
        for v in range(len(size)):
            other = np.flatnonzero((label != label[v]) & _comparable(size, size[v]))
            keep[v] = len(other) and np.count_nonzero(sig[other] == sig[v], axis=1).max() >= LEAST_EQUAL
        if keep.any():
            yield from (group.select(["bucket", "lo", "hi", "id", "label"]).filter(pa.array(keep))
                        .combine_chunks().to_batches())


def _links_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group, exact links that join its components: incidence matrix products, block of columns by block."""
    for group in sorted_groups(batches, ["bucket", "lo", "hi"]):
        ids, label = group.column("id").to_numpy(), group.column("label").to_numpy()
        sets = [s for _, s in shingle_sets(group.column("text"))]
        size = np.array([len(s) for s in sets], np.int64)
        member = np.repeat(np.arange(len(sets)), size)
        shingle, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        number = np.full(len(shingle), -1)
        shared = np.flatnonzero(count > 1)
        number[shared] = np.arange(len(shared))
        column = number[column]
        member, column = member[column >= 0], column[column >= 0]
        order = np.argsort(column, kind="stable")
        member, column = member[order], column[order]
        common = np.zeros((len(sets), len(sets)), np.float64)
        for c in range(0, len(shared), 4096):
            lo, hi = np.searchsorted(column, [c, c + 4096])
            dense = np.zeros((len(sets), 4096), np.float32)
            dense[member[lo:hi], column[lo:hi] - c] = 1
            common += dense @ dense.T
        union = size[:, None] + size[None, :] - common
        linked = (100 * common >= THRESHOLD * union) & (label[:, None] != label[None, :])
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        a, b = [], []
        for i, j in zip(*np.nonzero(np.triu(linked))):
            x, y = find(int(label[i])), find(int(label[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(ids[i])
                b.append(ids[j])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets reach the threshold."""
    for batch in batches:
        keep = []
        second = shingle_sets(batch.column("text_b"))
        for (_, x), (_, y) in zip(shingle_sets(batch.column("text_a")), second):
            common = intersection_size(x, y)
            keep.append(len(x) > 0 and 100 * common >= THRESHOLD * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _in_blocks(members: DataFrame, salt: int) -> DataFrame:
    """Cut each bucket of ``size`` members into blocks of about BLOCK, another way for each salt.

    Of up to PAIRED blocks all pairs are dealt out, so that a member travels at most PAIRED times; of more, each block by itself.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64(F.lit(salt), "id"), blocks).cast("int")
    others = F.when(blocks <= PAIRED, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(mine))
    return (members.withColumn("_mine", mine).withColumn("_other", F.explode(others))
            .withColumn("lo", F.least("_mine", "_other")).withColumn("hi", F.greatest("_mine", "_other")).drop("_mine", "_other", "size"))


def _across(members: DataFrame) -> DataFrame:
    """(bucket, lo, hi, id, label): blocks in which every two members of a bucket with different labels meet.

    Members of the bucket's largest component are cut into blocks, and so are the others; each block of one kind meets each of
    the other, and the others' blocks meet each other. A bucket of at most BLOCK members is one block.
    """
    count = members.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    shape = count.groupBy("bucket").agg(F.sum("n").alias("size"), F.max(F.struct("n", (-F.col("label")).alias("l"))).alias("top"))
    shape = shape.filter("size > top.n").select("bucket", "size", F.col("top.n").alias("most"), (-F.col("top.l")).alias("major"))
    rows = members.join(shape, "bucket")
    many, few = F.ceil(F.col("most") / BLOCK).cast("int"), F.ceil((F.col("size") - F.col("most")) / BLOCK).cast("int")
    key = F.xxhash64(F.lit(-1), "id")
    block = F.when(F.col("label") == F.col("major"), F.pmod(key, many)).otherwise(F.pmod(key, few)).cast("int")

    def pairs(lo: Column, hi: Column) -> Column:
        return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))

    large = F.transform(F.sequence(F.lit(0), few - 1), lambda i: pairs(F.col("_b"), i))
    # Blocks of the others come after those of the largest component.
    small = F.concat(F.transform(F.sequence(F.lit(0), many - 1), lambda j: pairs(j, F.col("_b"))),
                     F.transform(F.sequence(F.lit(0), few - 1), lambda i: pairs(many + F.least(F.col("_b"), i), F.greatest(F.col("_b"), i))))
    places = (F.when(F.col("size") <= BLOCK, F.array(pairs(F.lit(0), F.lit(0))))
              .when(F.col("label") == F.col("major"), large).otherwise(small))
    return rows.withColumn("_b", block).select("bucket", "id", "label", F.explode(places).alias("p")).select(
        "bucket", F.col("p.lo").alias("lo"), F.col("p.hi").alias("hi"), "id", "label")


def _grouped(df: DataFrame) -> DataFrame:
    keys = ["bucket", "lo", "hi"]
    return df.repartition(*keys).sortWithinPartitions(*keys)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when their sets of five-word shingles have a Jaccard similarity of at least 0.75;
    component_id is the smallest id reachable over links, kept tells whether it is the document itself.
    A null text or a text without words has no shingles and no links. Rows that repeat a doc_id are one document: a link of
    any of them counts for all that have words. A row without doc_id is linked with nothing: its component_id is null and it is
    kept. Other columns are ignored, whatever their names. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    profile = stored(docs.mapInArrow(
        _profiles, "id bigint, n bigint, f1 bigint, f2 bigint, sig binary, bands array<bigint>"), "profiles")
    filled = profile.filter("n > 0 and id is not null")
    # Equal sets: the smallest id stands for all of them.
    sets = stored(filled.groupBy("f1", "f2", "n").agg(F.min("id").alias("rep")), "sets")
    rows = stored(profile.select("id", "n", "f1", "f2").join(sets.select("f1", "f2", "rep"), ["f1", "f2"], "left")
                  .select("id", "n", F.when(F.col("n") > 0, F.col("rep")).alias("rep")), "rows")
    # Different sets of one id belong together.
    several = rows.filter("rep is not null and id is not null").groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a <> z")
    links = stored(several.select("id", "a").join(rows.select("id", F.col("rep").alias("b")), "id").filter("a <> b").select("a", "b").distinct(), "links")
    reps = (filled.join(sets.select("f1", "f2", F.col("rep").alias("id")), ["f1", "f2", "id"])
            .dropDuplicates(["id", "f1", "f2"]))
    banded = reps.select("id", F.explode("bands").alias("bucket"))
    buckets = (banded.groupBy("bucket")
               .agg(F.count("*").alias("size"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("s1"),
                    F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("s2"))
               .filter("size > 1")
               # Bands that gather the same members again need no second look.
               .groupBy("size", "s1", "s2").agg(F.min("bucket").alias("bucket")).select("bucket", "size"))
    members = stored(banded.join(buckets, "bucket"), "members")
    release(spark)
    signed = reps.select("id", "n", "sig")
    large = members.filter(F.col("size") > PAIRED * BLOCK)
    very_large = not large.isEmpty()
    near = texts = labels = None

    def labelled(rows: DataFrame) -> DataFrame:
        return (rows.join(labels, rows["id"] == labels["node"], "left")
                .select(*rows.columns, F.coalesce("component", "id").alias("label")))

    def fetched(ids: DataFrame) -> DataFrame:
        # The only passes that move texts: those of documents with a likely partner. Their ids grow with the corpus, so
        # the join is the same at every size.
        return stored(docs.join(ids.hint("merge"), "id"), "texts")

    for salt in range(ROUNDS if very_large else 1):
        if salt == 0:
            asked = members
        else:
            known = stored(labelled(large), "labelled")
            mixed = known.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("bucket")
            if mixed.isEmpty():
                break
            asked = known.join(mixed, "bucket").select("bucket", "id", "size")
        proposed = stored(_grouped(_in_blocks(asked, salt).join(signed, "id"))
                          .mapInArrow(_strongest_tree, "a bigint, b bigint").distinct(), "proposed")
        if salt:
            # Only what joins two components is news.
            ends = labels.select("node", "component")
            news = (proposed.join(ends.select(F.col("node").alias("a"), F.col("component").alias("_x")), "a", "left")
                    .join(ends.select(F.col("node").alias("b"), F.col("component").alias("_y")), "b", "left")
                    .filter("coalesce(_x, a) <> coalesce(_y, b)").select("a", "b"))
            proposed = stored(news, "proposed")
        ids = proposed.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        own = fetched(ids)
        pairs = proposed.join(own.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(
            own.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        fresh = stored(pairs.mapInArrow(_confirmed, "a bigint, b bigint").distinct(), "links")
        near = ids if near is None else near
        texts = own if texts is None else texts
        if salt and fresh.isEmpty():
            break
        links = links.unionByName(fresh)
        labels = stored(components(links), "labels")
        release(spark)
    open_ = members.select("bucket", "id", "size").join(near.withColumn("_near", F.lit(True)), "id", "left")
    # Where all pairs have been looked at, who has no likely partner is decided.
    open_ = labelled(open_.filter((F.col("size") > PAIRED * BLOCK) | F.col("_near")).select("bucket", "id"))
    undecided = stored(_grouped(_across(open_).join(signed, "id"))
                       .mapInArrow(_undecided, "bucket bigint, lo int, hi int, id bigint, label bigint"), "undecided")
    if very_large:
        texts = fetched(undecided.select("id").distinct())
    more = stored(_grouped(undecided.join(texts, "id")).mapInArrow(_links_across, "a bigint, b bigint").distinct(), "links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    joined = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    found = F.when(F.col("n") > 0, F.coalesce("component", "rep", "id")).otherwise(F.col("id"))
    found = F.when(F.col("id").isNotNull(), found)
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), found.alias("component_id"),
                         F.coalesce(F.col("id") == found, F.lit(True)).alias("kept"))
