"""Boilerplate lines by their frequency within a site, in DataFrame functions only.

For every site, the pages that contain a line are divided by the site's pages; a line above the ratio goes. Counts are
added up before they are shuffled, so a site or line with a third of all rows meets in no single task. Texts move
once: lines travel as 128-bit hashes, and what a page loses follows from its site and its text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_RATIO = 0.05


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """A line's identity: two 64-bit hashes of it without spaces at its ends."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("k1"), F.xxhash64(F.lit(1), bare).alias("k2"))


def drop_site_lines(pages: DataFrame, site: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                    min_pages: int = 3) -> DataFrame:
    """All rows and columns of ``pages``, with boilerplate lines taken out of ``text``, and counts of lines.

    A line (compared without spaces at its ends) goes if it is on at least ``min_pages`` pages of the site and on more
    than ``max_ratio`` of the site's pages (all its rows, those without text included). ``min_pages`` is the caller's: on sites
    of few pages every line is on a large part of them; 1 leaves the ratio alone to decide. Blank lines stay. Rows
    without a site are not judged, and a null text stays null with 0 lines. Repeated rows count as pages. Added
    columns: _n_lines, _n_dropped. An empty table gives an empty table.
    """
    columns = pages.columns
    # The row travels as one column, so that no column of the input can clash with those made here.
    base = pages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
                        F.col(site).cast("string").alias("_site"), F.col(text).cast("string").alias("_text"))
    base = (base.withColumn("_t1", F.xxhash64("_text")).withColumn("_t2", F.xxhash64(F.lit(1), "_text")))
    judged = base.filter("_site is not null and _text is not null")
    lines = (judged.select("_site", "_t1", "_t2", F.explode(F.array_distinct(F.transform(
        F.filter(_lines(F.col("_text")), lambda x: F.trim(x) != ""), _key))).alias("_key"))
        .select("_site", "_t1", "_t2", F.col("_key.k1").alias("_k1"), F.col("_key.k2").alias("_k2")))
    totals = base.groupBy("_site").agg(F.count("*").alias("_pages"))
    common = (lines.groupBy("_site", "_k1", "_k2").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_pages)
              .join(totals, "_site").filter(F.col("_n") > F.lit(max_ratio) * F.col("_pages"))
              .select("_site", "_k1", "_k2"))
    # The same text of the same site loses the same lines: at most as many as it has.
    lost = (lines.join(common, ["_site", "_k1", "_k2"]).groupBy("_site", "_t1", "_t2")
            .agg(F.collect_set(F.struct(F.col("_k1").alias("k1"), F.col("_k2").alias("k2"))).alias("_lost")))
    out = base.join(lost, ["_site", "_t1", "_t2"], "left").withColumn("_all", _lines(F.col("_text")))
    out = out.withColumn("_kept", F.when(F.col("_lost").isNull(), F.col("_all")).otherwise(
        F.filter("_all", lambda x: (F.trim(x) == "") | ~F.array_contains("_lost", _key(x)))))
    n = F.coalesce(F.size("_all"), F.lit(0))
    n = F.when(F.col("_text").isNull(), 0).otherwise(n)
    kept = F.when(F.col("_text").isNull(), 0).otherwise(F.size("_kept"))
    out = (out.withColumn("_n_lines", n.cast("bigint")).withColumn("_n_dropped", (n - kept).cast("bigint"))
           .withColumn("_new", F.when(F.col("_text").isNotNull(), F.array_join("_kept", "\n"))))
    return out.select(*[F.col("_new").alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in columns], "_n_lines", "_n_dropped")
