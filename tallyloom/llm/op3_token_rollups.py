"""Token counts as rollups maintained by signed changes.

A change is one row with its group (source, language, tokenizer version), a sign and a token count: +1 inserts a document,
-1 deletes it, and a revision is a -1 of the old count with a +1 of the new one. A batch of changes becomes partial sums
per group, summed before the shuffle, in a folder of its own that is marked when it is complete. The totals are the sums of
all marked folders: they are additive, so the order of batches does not matter and a batch costs what it changes.

Commits are idempotent: a marked batch is not written again, whatever is passed, and a folder without a mark (a driver that died)
is never read. Marks are created through Hadoop's file system, so the store may lie wherever Spark can write. Compaction keeps the
cost of totals from growing with the number of batches.

Defined results: a null or empty text has no tokens and still counts as a document; null sources and languages are groups;
repeated rows count as often as they occur; groups whose documents come to zero are left out; further columns are ignored; an
empty batch changes nothing and is committed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.skew import join_counted
from tallyloom.llm.tokens import ids
from tallyloom.operators.staging import stage
from tallyloom.session import new_folder
from tallyloom.sources import files

GROUP = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, documents bigint, tokens bigint"
#: A mark without a name is left by a driver that died, once it is this old.
DEAD_SECONDS = 600


def count_tokens(rows: DataFrame, texts: list[str], vocabularies: list[str]) -> DataFrame:
    """``rows`` without the text columns, with ``<text>_tokens``: counts of each text by vocabulary, in their order (null texts: null)."""
    kept = [c for c in rows.columns if c not in texts]
    schema = rows.select(*kept).schema.simpleString()[7:-1]
    schema = ", ".join(x.replace(":", " ", 1) for x in schema.split(",")) + "".join(f", {t}_tokens array<bigint>" for t in texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(b.schema.get_field_index(c)) for c in kept]
            for t in texts:
                found = (x.as_py() for x in b.column(b.schema.get_field_index(t)))
                columns.append(pa.array([None if x is None else [len(ids(x, v)) // 4 for v in vocabularies] for x in found], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, kept + [f"{t}_tokens" for t in texts])

    return rows.mapInArrow(run, schema)


def changes(counted: DataFrame, sign: int, vocabularies: list[str], tokens: Column) -> DataFrame:
    """Signed changes of rows with an array of counts, one per vocabulary."""
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("tokenizer"), F.coalesce(tokens[i], F.lit(0)).alias("tokens")) for i, v in enumerate(vocabularies)]))
    return counted.select("source", "lang", each.alias("e")).select("source", "lang", "e.tokenizer", F.lit(sign).alias("sign"), "e.tokens")


class Rollup:
    """A store of committed batches under one folder.

    A batch's sums lie in a folder of their own. It counts from the moment its mark exists: a small file that names the folder and is created
    in one step, so of two drivers that commit the same batch one wins and the other's sums are removed; a mark without a name (its driver died) does not
    count and may be replaced. :meth:`compact` sums what is there into a base and lists the batches that it holds; they stay committed, and
    totals read the base and later batches only. Folders that a compaction has replaced go with the next one, so readers that have begun are not
    disturbed.
    """

    def __init__(self, spark: SparkSession, root: str, dead_seconds: float = DEAD_SECONDS):
        self.spark, self.root, self.dead_seconds = spark, root.rstrip("/"), dead_seconds

    def _folder(self, batch: str) -> str:
        return files.read_text(self.spark, f"{self.root}/marks/{batch}").strip()

    def committed(self, batch: str) -> bool:
        return bool(self._folder(batch))

    def _store(self, sums: DataFrame) -> str:
        name = uuid.uuid4().hex
        sums.select(*GROUP, "documents", "tokens").write.parquet(f"{self.root}/sums/{name}")
        return name

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Add a batch of :func:`changes`; false, without reading them, if the batch is already there."""
        if self.committed(batch):
            return False
        sums = signed.groupBy(*GROUP).agg(F.sum("sign").cast("long").alias("documents"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"))
        name, mark = self._store(sums), f"{self.root}/marks/{batch}"
        if files.exists(self.spark, mark) and not self._folder(batch) and time.time() - files.modified(self.spark, mark) >= self.dead_seconds:
            files.remove(self.spark, mark)
        if files.write_text(self.spark, mark, name):
            return True
        files.remove(self.spark, f"{self.root}/sums/{name}")
        return False

    def _base(self) -> tuple[int, str | None, set[str]]:
        """Number, folder and batches of the last base; zero and nothing before the first."""
        for name in reversed(files.names(self.spark, f"{self.root}/bases")):
            folder, *batches = files.read_text(self.spark, f"{self.root}/bases/{name}").split("\n")
            if folder and batches[-1:] == ["end"]:
                return int(name), folder, set(batches[:-1])
        return 0, None, set()

    def _parts(self) -> tuple[list[str], dict[str, str]]:
        """Folders that make up the totals, and the batches beyond the base with theirs."""
        _, folder, held = self._base()
        later = {b: f for b in files.names(self.spark, f"{self.root}/marks") if b not in held and (f := self._folder(b))}
        return [*([folder] if folder else []), *later.values()], later

    def _sum(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        sums = self.spark.read.schema(SCHEMA).parquet(*[f"{self.root}/sums/{f}" for f in folders])
        return (sums.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where("documents <> 0 OR tokens <> 0"))

    def totals(self) -> DataFrame:
        return self._sum(self._parts()[0])

    def compact(self) -> bool:
        """Sum all batches into a new base; false if there is nothing to sum, or if another driver was faster."""
        number, before, held = self._base()
        folders, later = self._parts()
        if not later:
            return False
        name = self._store(self._sum(folders))
        if not files.write_text(self.spark, f"{self.root}/bases/{number + 1:09d}", "\n".join([name, *sorted(held | set(later)), "end"])):
            files.remove(self.spark, f"{self.root}/sums/{name}")
            return False
        for batch in held:  # replaced by the base before this one
            files.remove(self.spark, f"{self.root}/sums/{self._folder(batch)}")
        for old in files.names(self.spark, f"{self.root}/bases")[:-2]:
            files.remove(self.spark, f"{self.root}/sums/{files.read_text(self.spark, f'{self.root}/bases/{old}').split()[0]}")
        return True


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: all documents inserted; texts that lose repeated lines revised; later copies of equal texts deleted; batches replayed."""
    vocabularies = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "text")
    shorter = F.array_join(F.array_distinct(F.split("text", "\n")), "\n")
    docs = docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "text",
                       F.when(shorter != F.col("text"), shorter).alias("revised"))
    counted = stage(count_tokens(docs, ["text", "revised"], vocabularies), "token-counts")
    latest = F.coalesce("revised_tokens", "text_tokens")
    revised = counted.where("revised_tokens IS NOT NULL")
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = join_counted(counted.withColumn("uid", F.monotonically_increasing_id()), stage(first, "copied"), "digest", "uid", counted.count())
    copies = copies.where("doc_id > first")
    rollup = Rollup(spark, new_folder(spark, "rollup"))
    batches = {"load": changes(counted, 1, vocabularies, F.col("text_tokens")),
               "revise": changes(revised, -1, vocabularies, F.col("text_tokens")).union(changes(revised, 1, vocabularies, F.col("revised_tokens"))),
               "delete": changes(copies, -1, vocabularies, latest)}
    for name in [*batches, *batches]:
        rollup.commit(name, batches[name])
        if name == "revise":
            rollup.compact()
    return rollup.totals()
