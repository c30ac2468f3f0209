"""Where the operational tables of a company come from."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class MissingTable(Exception):
    """The source has no such table or column."""


@dataclass(frozen=True)
class FrameSource:
    """Tables already at hand as DataFrames."""

    tables: Mapping[str, DataFrame]

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise MissingTable(f"table {name} not found in source")
        return self.tables[name]


@dataclass(frozen=True)
class ParquetSource:
    """One parquet folder or file per table: ``<root>/<table>`` or ``<root>/<table>.parquet``."""

    spark: SparkSession
    root: str
    suffix: str = ""

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}{self.suffix}")


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a relational source, each read in ``partitions`` ranges of its id column.

    Column pruning and the incremental predicates are pushed into the remote query, because the
    extraction expresses both on the bare source columns with literal marks.
    """

    spark: SparkSession
    url: str
    schema: str
    options: Mapping[str, str] = field(default_factory=dict)
    split: Mapping[str, tuple[str, int, int]] = field(default_factory=dict)  # table -> column, lo, hi
    partitions: int = 64

    def table(self, name: str) -> DataFrame:
        reader = (self.spark.read.format("jdbc").option("url", self.url)
                  .option("dbtable", f"{self.schema}.{name}")
                  # The marks are timestamps without zone; the columns must be read alike to be compared remotely.
                  .option("preferTimestampNTZ", "true")
                  .option("fetchsize", "10000").options(**self.options))
        if name in self.split:
            column, low, high = self.split[name]
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high,
                                    numPartitions=self.partitions)
        return reader.load()
