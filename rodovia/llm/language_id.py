"""Language of whole texts by rank-order n-gram profiles.

A profile lists the most frequent n-grams (1 to 3 letters, words padded with a blank) of a language in order of
frequency, ties by code points. A document's own profile is compared with each: the out-of-place distance adds, for every
n-gram of the document, how far its rank is from the language's, or the profile length if the language lacks it.
The nearest language wins, ties by name.

Profiles are learned from the whole texts of at most SAMPLE documents a language, those with the smallest hash of
their id, or of all labelled documents.

A floor tells whether the nearest language is near at all. Labelled documents are scored by profiles learned without their
fold; a text is in no learned language if its score is further below their lowest twentieth, at the same language and number of
distinct n-grams, than REACH times what lies between that and their median. All scores have a say in every median, and the distances
from it in every twentieth, those of other languages and sizes with less weight; the floor is then drawn towards DEFAULT_FLOOR, the
more the less they weigh in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rodovia.llm.tables import stored

PROFILE = 300
SAMPLE = 2000
UNKNOWN = "und"
FOLDS = 5
LOW = 0.05       # quantile
REACH = 2.5
DEFAULT_FLOOR = 0.0    # that of a language without any score
DEFAULT_WEIGHT = 0.25  # of it, beside 1 for each score of a text's own language and class
OTHER_LANGUAGE = 0.3   # weight of a score in the floors of another language
OTHER_SIZE = 0.1, 0.5  # in median and twentieth, for each class that its number of distinct n-grams is away
_CLASSES = 22    # powers of two of the number of distinct n-grams
_SHIFT = 21
_PIECE = 1 << 20  # letters of a text that are looked at together
_HELD = 1 << 19   # n-grams of texts that are counted together
_DIGITS = 4       # of a score, where scores are counted


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return table


def _pieces(text: str, letters: np.ndarray) -> Iterator[str]:
    """A text in pieces that end behind a character that is no letter; no n-gram crosses such a place."""
    text = text.lower()
    lo = 0
    while len(text) - lo > 2 * _PIECE:
        hi = lo + _PIECE
        while hi < len(text) and letters[ord(text[hi - 1])]:
            hi += 1
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def _counted(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text in order, and how often each occurs."""
    found = []
    for piece in _pieces(text, letters):
        grams = np.sort(_grams(piece, letters))
        edge = np.flatnonzero(np.concatenate([[len(grams) > 0], grams[1:] != grams[:-1]]))
        found.append((grams[edge], np.diff(np.append(edge, len(grams)))))
    if len(found) == 1:
        return found[0]
    gram, inverse = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    return gram, np.bincount(inverse, np.concatenate([n for _, n in found]), len(gram)).astype(np.int64)


def _grams(text: str, letters: np.ndarray) -> np.ndarray:
    """All n-grams of a text in lower case, packed into integers of 21 bits a character; empty without letters."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = letters[code]
    if not letter.any():
        return np.zeros(0, np.int64)
    # Runs of other characters are one blank, also before the first and after the last word.
    code = np.concatenate([[32], np.where(letter, code, 32), [32]])
    letter = np.concatenate([[False], letter, [False]])
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.argmax(letter) - 1] = True
    code, letter = code[keep], letter[keep]
    two = (code[:-1] << _SHIFT) | code[1:]
    three = (two[:-1] << _SHIFT) | code[2:]
    return np.concatenate([code[letter], two, three[letter[1:-1]]])


def _top(gram: np.ndarray, count: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams in order; ties by code points (``gram`` is sorted)."""
    return gram[np.argsort(-count, kind="stable")[:size]]


def _count_by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = _letters()
    for batch in batches:
        parts: dict[str, list] = {}
        held = 0
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            gram, count = _counted(text.as_py(), letters)
            if len(gram):
                parts.setdefault(lang, []).append((gram, count))
                held += len(gram)
            if held > _HELD:
                yield from (_summed(*part) for part in parts.items())
                parts, held = {}, 0
        yield from (_summed(*part) for part in parts.items())


def _summed(lang: str, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    gram, inverse = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    count = np.bincount(inverse, np.concatenate([c for _, c in found])).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.repeat(lang, len(gram)), pa.array(gram), pa.array(count)], ["lang", "gram", "n"])


def _sampled(docs: DataFrame, doc_id: str, text: str, lang: str, sample: int | None) -> DataFrame:
    """(lang, text, id) of the documents with the smallest hashes of each language, or of all labelled ones.

    Counts per language bound the hashes to those of about twice as many documents, so that only these are ranked.
    """
    rows = (docs.select(F.xxhash64(F.col(doc_id).cast("string")).alias("h"), F.col(lang).cast("string").alias("lang"),
                        F.col(text).cast("string").alias("text"), F.col(doc_id).alias("id"))
            .filter("id is not null and lang is not null and text is not null"))
    if sample is None:
        return rows.select("lang", "text", "id")
    part = 2 * sample / F.col("n")
    # Written, so that Spark knows how small they are and need not deal the rows by language to join them.
    limits = stored(rows.groupBy("lang").agg(F.count("*").alias("n"))
                    .select("lang", F.when(part >= 1, F.lit(2 ** 63 - 1)).otherwise((part * 2.0 ** 64 - 2.0 ** 63).cast("bigint"))
                            .alias("limit")), "limits")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    bounds = (rows.select("lang", "h").join(limits, "lang").filter("h <= limit").withColumn("place", place)
              .filter(F.col("place") <= sample).groupBy("lang").agg(F.max("h").alias("bound")))
    return rows.join(stored(bounds, "bounds"), "lang").filter("h <= bound").select("lang", "text", "id")


def learn_profiles(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                   usable: Column | None = None, sample: int | None = SAMPLE, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Language -> n-grams in order, from at most ``sample`` documents a language (more if hashes tie), or from all for None.

    Rows with a null id, text or language, or for which ``usable`` is not true, teach nothing. The driver gets
    ``size`` numbers a language. Without any row that teaches the result is empty. Repeated ids are in or out together.
    """
    rows = _sampled(docs.filter(usable) if usable is not None else docs, doc_id, text, lang, sample)
    counts = (rows.select("lang", "text").mapInArrow(_count_by_language, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= size).collect()
    profiles: dict[str, list] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return {k: np.array(v, np.int64) for k, v in profiles.items()}


def learn_floors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int | None = None,
                 size: int = PROFILE) -> dict[str, np.ndarray]:
    """Language -> least score of a text in it, by the power of two of the number of its distinct n-grams.

    From all labelled documents, or at most ``sample`` a language, each scored without its fold; documents that
    another language is nearest to teach nothing. The driver gets how many there are of each language, power of two and score, to
    four digits. Medians and twentieths are quantiles over all scores, weighted by OTHER_LANGUAGE and OTHER_SIZE where they are
    of another language or class.
    """
    rows = _sampled(docs, doc_id, text, lang, sample).withColumn("fold", _fold(F.col("id")).cast("int")).select("fold", "lang", "text")
    # Counted once by fold and language; a profile without a fold is the sum of the others.
    counts = (rows.select(F.concat("fold", "lang").alias("lang"), "text")
              .mapInArrow(_count_by_language, "lang string, gram bigint, n bigint")
              .groupBy(F.substring("lang", 1, 1).cast("int").alias("fold"), F.expr("substring(lang, 2)").alias("lang"), "gram")
              .agg(F.sum("n").alias("n")))
    counts = (counts.withColumn("without", F.explode(F.array(*[F.lit(f) for f in range(FOLDS)]))).filter("without <> fold")
              .groupBy("without", "lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("without", "lang").orderBy(F.desc("n"), "gram"))
    profiles: list[dict[str, list]] = [{} for _ in range(FOLDS)]
    for r in sorted(counts.withColumn("rank", rank).filter(F.col("rank") <= size).collect(), key=lambda r: r["rank"]):
        profiles[r["without"]].setdefault(r["lang"], []).append(r["gram"])
    learned = [{k: np.array(v, np.int64) for k, v in p.items()} for p in profiles]
    scored = rows.mapInArrow(_predict_without_fold(learned, size), "lang string, lang_pred string, score double, n_grams bigint, near boolean")
    power = F.least(F.length(F.bin("n_grams")), F.lit(_CLASSES)) - 1
    right = (scored.filter("lang = lang_pred").groupBy("lang", power.alias("power"), F.round("score", _DIGITS).alias("score"))
             .agg(F.count("*").alias("n")).collect())
    return floors_of([(r["lang"], 1 << r["power"], r["score"]) for r in right], [r["n"] for r in right])


def floors_of(scores: list[tuple[str, int, float]], times: Sequence[int] | None = None) -> dict[str, np.ndarray]:
    """Language -> floor for each class, from (language, number of distinct n-grams, score) of documents told rightly, each that many times."""
    score = np.array([r[2] for r in scores])
    times = np.ones(len(scores)) if times is None else np.array(times, float)
    classes = np.array([_class(r[1]) for r in scores], np.int64)
    names, lang = np.unique(np.array([r[0] for r in scores], object), return_inverse=True)

    def weights(name: int, c: int, other_size: float) -> np.ndarray:
        return times * np.where(lang == name, 1.0, OTHER_LANGUAGE) * other_size ** np.abs(classes - c)

    def quantile(of: np.ndarray, order: np.ndarray, weight: np.ndarray, part: float) -> float:
        total = np.cumsum(weight[order])
        return of[order[np.searchsorted(total, part * total[-1])]]

    order = np.argsort(score, kind="stable")
    middle = np.array([[quantile(score, order, weights(i, c, OTHER_SIZE[0]), 0.5) for c in range(_CLASSES)] for i in range(len(names))])
    if len(scores):
        apart = score - middle[lang, classes]
        order = np.argsort(apart, kind="stable")
    floors = {}
    for i, name in enumerate(names):
        low = np.array([min(0.0, quantile(apart, order, weights(i, c, OTHER_SIZE[1]), LOW)) for c in range(_CLASSES)])
        weight = np.array([weights(i, c, OTHER_SIZE[0]).sum() for c in range(_CLASSES)])
        floors[name] = (weight * (middle[i] + (1 + REACH) * low) + DEFAULT_WEIGHT * DEFAULT_FLOOR) / (weight + DEFAULT_WEIGHT)
    return floors


def _class(n_grams: int) -> int:
    return min(n_grams.bit_length(), _CLASSES) - 1


def _predict(profiles: dict[str, np.ndarray], size: int, floors: dict[str, np.ndarray] | None = None) -> Callable:
    """Adds lang_pred, score, n_grams and near: whether a text has letters and, if any profile is known, is not below the floor of
    its nearest language and shares an n-gram with a profile. With ``floors`` lang_pred is unknown for texts that are not near."""
    names = sorted(profiles)
    known = np.unique(np.concatenate([profiles[n] for n in names])) if names else np.zeros(0, np.int64)
    rank = np.full((len(known) + 1, len(names)), -1, np.int64)
    for j, n in enumerate(names):
        rank[np.searchsorted(known, profiles[n]), j] = np.arange(len(profiles[n]))

    def run(batches: Iterator[pa.RecordBatch], letters: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        letters = _letters() if letters is None else letters
        for batch in batches:
            lang, score, n_grams, near = [], [], [], []
            for text in batch.column(batch.num_columns - 1):
                gram, count = _counted(text.as_py() or "", letters)
                n_grams.append(len(gram))
                if len(gram) == 0 or not names:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    near.append(len(gram) > 0)
                    continue
                own = _top(gram, count, size)
                at = np.searchsorted(known, own)
                at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != own)] = len(known)
                theirs = rank[at]
                apart = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(own))[:, None])).sum(axis=0)
                best = int(np.argmin(apart))
                score.append(1 - int(apart[best]) / (size * len(own)))
                floor = floors[names[best]][_class(len(gram))] if floors and names[best] in floors else 0
                near.append(score[-1] > 0 and score[-1] >= floor)
                lang.append(names[best] if floors is None or near[-1] else UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n_grams, pa.int64()), pa.array(near, pa.bool_())],
                batch.schema.names[:-1] + ["lang_pred", "score", "n_grams", "near"])
    return run


def _predict_without_fold(profiles: list[dict[str, np.ndarray]], size: int) -> Callable:
    """``_predict`` of (lang, text) by the profiles of the fold in front of them."""
    runs = [_predict(p, size) for p in profiles]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in batches:
            for fold, one in enumerate(runs):
                yield from one(iter([batch.filter(pc.equal(batch.column(0), fold)).select(["lang", "text"])]), letters)
    return run


def predict_languages(docs: DataFrame, profiles: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text",
                      size: int = PROFILE) -> DataFrame:
    """(doc_id, lang_pred, score) per row; score is 1 minus the distance as a part of the largest possible one.

    A null text or one without letters is ``und`` with score 0, and so is every text if no profile was learned.
    Null and repeated ids stay as they are. Other columns are ignored. An empty table gives an empty table.
    """
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        _predict(profiles, size), "doc_id bigint, lang_pred string, score double, n_grams bigint, near boolean").drop("n_grams", "near")


def with_languages(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", size: int = PROFILE,
                   floors: dict[str, np.ndarray] | None = None) -> DataFrame:
    """(row, lang_pred, score, n_grams, near): every row of ``docs`` with all its columns as one struct, and its prediction.

    n_grams counts distinct ones: 0 without letters. near is false without letters, and if any profile is known also below the
    floor of the nearest language (of ``learn_floors``, maybe empty) and without an n-gram of any profile; with ``floors``
    lang_pred is ``und`` then. An empty table gives an empty table.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("t"))
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("n_grams", T.LongType()), T.StructField("near", T.BooleanType())])
    return rows.mapInArrow(_predict(profiles, size, floors), schema)


def _fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the CRC-32 of its id as text; false without an id."""
    return F.coalesce(_fold(doc_id) == 0, F.lit(False))
