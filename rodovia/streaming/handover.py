"""From a backlog to a live feed in one result.

The cut records which files of the feed are history. They are computed by the batch functions, in whatever order they lie there,
and the result is kept as mergeable parts; the stream takes all other files of the feed with a short watermark, so its state holds
minutes, not the backlog. Readers add both sides up.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rodovia.streaming import jobs
from rodovia.streaming.parts import united


class HandOver:
    """One feed folder of parquet files that are never changed once they are there; ``root`` keeps the cut and all results."""

    def __init__(self, spark: SparkSession, feed: str, schema: StructType, root: str):
        self.spark, self.feed, self.schema, self.root = spark, feed, schema, root.rstrip("/")

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def history_files(self) -> list[str]:
        """The files at the cut. The first call makes the cut, later ones (also of another process) find it.

        Listing a folder is the driver's in any file source; the list is as long as the folder is at the cut.
        """
        if not self._exists("cut"):
            (self.spark.read.schema(self.schema).parquet(self.feed).select(F.col("_metadata.file_path").alias("file")).distinct()
             .write.mode("overwrite").json(f"{self.root}/cut"))
        return sorted(r["file"] for r in self.spark.read.schema("file string").json(f"{self.root}/cut").collect())

    def history(self) -> DataFrame:
        files = self.history_files()
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)

    def live(self, session: SparkSession | None = None, files_per_batch: int = 1000) -> DataFrame:
        """The feed without the files at the cut; the filter on file names leaves those unread."""
        stream = jobs.file_stream(session or self.spark, self.feed, self.schema, files_per_batch)
        files = self.history_files()
        return stream.filter(~F.col("_metadata.file_path").isin(files)) if files else stream

    def keep_history(self, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The result of ``build`` on the history, computed once."""
        if not self._exists(f"history/{name}"):
            build(self.history()).write.mode("overwrite").parquet(f"{self.root}/history/{name}")
        return self.spark.read.parquet(f"{self.root}/history/{name}")

    def follow(self, name: str, build: Callable[[DataFrame], DataFrame], session: SparkSession | None = None,
               files_per_batch: int = 1000):
        """Take what the feed holds beyond the cut; parts of windows that change are written anew."""
        return jobs.update_table(build(self.live(session, files_per_batch)), f"{self.root}/live/{name}",
                                 f"{self.root}/checkpoint/{name}")

    def append(self, name: str, build: Callable[[DataFrame], DataFrame], session: SparkSession | None = None,
               files_per_batch: int = 1000):
        return jobs.append_table(build(self.live(session, files_per_batch)), f"{self.root}/live/{name}", f"{self.root}/checkpoint/{name}")

    def live_rows(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/live/{name}")

    def parts(self, name: str, by: Sequence[str]) -> DataFrame:
        """History and the newest state of the live windows, added up per period and group."""
        past = self.spark.read.parquet(f"{self.root}/history/{name}")
        live = jobs.current(self.spark, f"{self.root}/live/{name}", ["inicio", *by])
        return united(past.unionByName(live.select(past.columns)), by)
