"""Totals of token counts that follow changes of the corpus by signed deltas.

A batch holds inserts, deletes and revised counts. It is added up to one signed row per source, language and tokenizer
version, written as one folder and put into its place by one rename, so a batch that broke off does not exist, and one that is
applied again changes nothing. Totals are the sum of all committed batches; compacting replaces batches by their sum, which
appears together with their names, again by one rename.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

KEYS = ["source", "lang", "tokenizer"]
INSERT, DELETE, REVISE = "insert", "delete", "revise"
_DELTA = "source string, lang string, tokenizer string, docs bigint, tokens bigint"


def _count(file: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import tiktoken

        with open(file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            n = [len(encoding.encode_ordinary(t.as_py() or "")) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(n, pa.int64())], batch.schema.names[:-1] + ["n"])
    return run


def count_tokens(docs: DataFrame, columns: list[str], text: str = "text", tokenizer_file: str | None = None) -> DataFrame:
    """``columns`` and n, the number of byte-level BPE tokens of the whole text (0 for null), of every row.

    A column named n among ``columns`` is replaced by the count. Repeated rows are counted each, nulls in other columns
    stay. An empty table gives an empty table.
    """
    columns = [c for c in columns if c.lower() != "n"]
    picked = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("t"))
    schema = T.StructType([picked.schema["row"], T.StructField("n", T.LongType())])
    return picked.mapInArrow(_count(tokenizer_file), schema).select(*[F.col("row").getField(c).alias(c) for c in columns], "n")


class TokenTotals:
    """Totals under a folder that all executors reach; batches may be applied in any order, each once.

    ``batches/<name>`` holds the deltas of one batch, ``sums/<number>/totals`` the sum of earlier ones and ``sums/<number>/members``
    the names of those of them that still lie in ``batches``. Both are written elsewhere and then renamed as a whole to a place
    that must be free: a reader sees all of it or nothing, and of two writers one fails. ``vacuum`` moves the folders of summed
    batches, emptied, to ``done``, where the name stays known.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, kind: str) -> list[str]:
        folder, files = self._path(kind), self._files()
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        mark = "totals/_SUCCESS" if kind == "sums" else "_SUCCESS"
        return sorted(n for n in names if files.exists(self._path(f"{kind}/{n}/{mark}")))

    def _publish(self, draft: str, name: str) -> bool:
        """Move a finished folder to its place in one step; False if the place is taken."""
        files, to = self._files(), self._path(name)
        files.mkdirs(to.getParent())
        jvm = self.spark._jvm
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark._sc._gateway.new_array(kinds, 1)
        options[0] = getattr(kinds, "NONE")
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.spark._jsc.hadoopConfiguration()).rename(
                self._path(draft), to, options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception):
                raise
            files.delete(self._path(draft), True)
            return False
        return True

    def _state(self) -> tuple[str | None, list[str], list[str]]:
        """The newest sum, the batches in it that still lie in their folder, and the committed batches that it lacks."""
        # Batches first: one that is committed after this is no member of a sum found later than it.
        here, sums = self._names("batches"), self._names("sums")
        if not sums:
            return None, [], here
        done = {r[0] for r in self.spark.read.schema("batch string").json(f"{self.root}/sums/{sums[-1]}/members").collect()}
        return sums[-1], [b for b in here if b in done], [b for b in here if b not in done]

    def _known(self, batch: str) -> bool:
        files = self._files()
        return any(files.exists(self._path(f"{kind}/{batch}/_SUCCESS")) for kind in ("batches", "done"))

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch under its name; False, and no change, if a batch of this name is committed.

        ``changes`` has op (insert, delete or revise), source, lang, tokenizer, tokens, and for revise old_tokens. A delete
        takes its tokens and one document away, a revise replaces old_tokens by tokens. Null source, language or version is a
        group of its own; null counts are 0; repeated rows count each; rows with another op are an error. An empty table is a
        batch without effect. Other columns are ignored.
        """
        if "/" in batch or batch.startswith(("_", ".")):
            raise ValueError("a batch name is a folder name")
        if self._known(batch):
            return False
        op, new, old = F.col("op"), F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
        if "old_tokens" not in changes.columns:
            changes = changes.withColumn("old_tokens", F.lit(0))
        docs = F.when(op == INSERT, 1).when(op == DELETE, -1).when(op == REVISE, 0).otherwise(
            F.raise_error(F.lit("op must be insert, delete or revise")).cast("int"))
        tokens = F.when(op == INSERT, new).when(op == DELETE, -new).when(op == REVISE, new - old)
        draft = f"drafts/{uuid.uuid4().hex}"
        (changes.select(*[F.col(k).cast("string") for k in KEYS], docs.alias("docs"), tokens.alias("tokens"))
         .groupBy(*KEYS).agg(F.sum("docs").cast("bigint").alias("docs"), F.sum("tokens").cast("bigint").alias("tokens"))
         .write.parquet(f"{self.root}/{draft}"))
        self._drop_broken(f"batches/{batch}")
        return self._publish(draft, f"batches/{batch}")

    def _drop_broken(self, name: str) -> None:
        """A folder without commit marker is not what ``_publish`` leaves; it is in nobody's way."""
        files = self._files()
        if files.exists(self._path(name)) and not files.exists(self._path(f"{name}/_SUCCESS")):
            files.delete(self._path(name), True)

    def _deltas(self, total: str | None, fresh: list[str]) -> DataFrame:
        paths = [f"{self.root}/sums/{total}/totals"] if total else []
        paths += [f"{self.root}/batches/{b}" for b in fresh]
        if not paths:
            return self.spark.createDataFrame([], _DELTA)
        return self.spark.read.schema(_DELTA).parquet(*paths)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens) over all committed batches, without groups that came to nothing."""
        total, _, fresh = self._state()
        return (self._deltas(total, fresh).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .filter("docs <> 0 or tokens <> 0"))

    def compact(self) -> bool:
        """Write the sum of all committed batches; batches committed meanwhile stay beside it.

        False, and no change, if there is nothing new or another compaction was faster.
        """
        total, within, fresh = self._state()
        if not fresh:
            return False
        draft = f"drafts/{uuid.uuid4().hex}"
        # One reading of the state decides both what is summed and which names count as summed.
        self._deltas(total, fresh).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.parquet(
            f"{self.root}/{draft}/totals")
        self.spark.createDataFrame([(b,) for b in within + fresh], "batch string").write.json(f"{self.root}/{draft}/members")
        return self._publish(draft, f"sums/{int(total) + 1 if total else 1:012d}")

    def vacuum(self) -> list[str]:
        """Empty the batches that the newest sum holds, and delete older sums and drafts; their names.

        No apply or compact may be in progress; totals asked for before this may have to be asked for again.
        """
        total, within, _ = self._state()
        files = self._files()
        for batch in within:
            for file in files.listStatus(self._path(f"batches/{batch}")):
                if file.getPath().getName() != "_SUCCESS":
                    files.delete(file.getPath(), True)
            self._publish(f"batches/{batch}", f"done/{batch}")
        for old in self._names("sums"):
            if total and old < total:
                files.delete(self._path(f"sums/{old}"), True)
        files.delete(self._path("drafts"), True)
        return within
