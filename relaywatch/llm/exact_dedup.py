"""Exact deduplication against a persistent digest index (operator 6).

The index is a table of one row per distinct text seen so far (digest, keep_id,
n_rows), bucketed and sorted by the SHA-256 digest in a shared folder. A batch
of documents is reduced to its distinct digests; those the index lacks are found
by a sort-merge anti-join that reads the index bucket by bucket without a
shuffle, and are appended. Texts are equal when identical after no change.

Of equal texts within a batch the row with the largest doc_id stays (of rows
that share it, one). A text the index already has is dropped; its ``keep_id`` is
the one on record, and ``group_size`` counts the batch's rows besides the rows
on record when the text was appended.

A digest that a third of all rows share is aggregated before it is shuffled, and
the join that brings a group's result back to its rows is one whose skewed
partitions Spark splits. Only (doc_id, digest, row key) of a row is shuffled,
never its text. Null and empty texts are equal; a null doc_id is smaller than
any other; an empty table gives no rows and appends nothing.

The index is partitioned by batch: a batch is deduplicated against all other
batches and appended, last, as a partition of its own. A batch that runs again
under its name, after a failure at any point, meets the index without its own rows,
returns the same result and writes its partition anew. Partitions share the
bucketing, so a bucket of all batches is read by one task, which sorts it; very long
texts take part by their digest only, and other columns may have any name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaywatch.llm import common as C

SCHEMA = "digest binary, keep_id long, n_rows long"
BUCKETS = 64  # fixed for the life of an index; size it for about 256 MB a bucket


class DigestIndex:
    """A bucketed, sorted table at ``path`` with a partition per batch, attached to
    the session under a name of its own. An index of another session is attached by
    its path."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + C.scratch(spark, "x").rsplit("-", 1)[1]
        p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
        self._fs = p.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
        self._fs.mkdirs(p)
        spark.sql(f"CREATE TABLE {self.name} ({SCHEMA}, batch string) USING parquet "
                  f"PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def read(self, without: str | None = None) -> DataFrame:
        """All rows, but those of the batch ``without``."""
        rows = self.spark.table(self.name)
        return (rows if without is None else rows.filter(F.col("batch") != without)).drop("batch")

    def append(self, rows: DataFrame, batch: str | None = None) -> None:
        """Add rows whose digests the index lacks as ``batch`` (a name of its own by
        default), in place of what an earlier attempt left there; one file per
        bucket."""
        name = batch or uuid.uuid4().hex
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={name}")  # noqa: SLF001
        self._fs.delete(p, True)
        (rows.withColumn("batch", F.lit(name)).repartition(self.buckets, "digest")
         .sortWithinPartitions("digest").write.insertInto(self.name))
        self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.name)

    def detach(self) -> None:
        """Forget the name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, whole-row key and a number that tells equal rows apart,
    written once so that the number holds."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), C.row_key(docs).alias("k_row"),
                       F.monotonically_increasing_id().alias("row"))
    return C.stored(rows, "digests")


def dedup(docs: DataFrame, index: DigestIndex, *, id_col: str = "doc_id",
          text_col: str = "text", batch: str | None = None) -> DataFrame:
    """Deduplicate a batch against the index and append what is new under the name
    ``batch`` (by which the batch can run again). One row per document: doc_id,
    k_row, keep_id, group_size, kept, text_sha256. The result is stored before the
    index is changed."""
    rows = digests(docs, id_col=id_col, text_col=text_col)
    groups = rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("n"))
    # The groups meet the index in its own bucketing.
    groups = C.stored(groups, "groups").repartition(index.buckets, "digest")
    known = index.read(without=batch).select("digest", F.col("keep_id").alias("known_id"), "n_rows")
    fresh = groups.hint("merge").join(known, "digest", "left_anti").select(
        "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("row"),
        F.col("n").alias("group_size"))
    old = groups.hint("merge").join(known, "digest").select(
        "digest", F.col("known_id").alias("keep_id"), F.lit(None).cast("long").alias("row"),
        (F.col("n") + F.col("n_rows")).alias("group_size"))
    verdict = C.stored(fresh.unionByName(old), "verdicts")
    of_row = verdict.withColumnRenamed("row", "kept_row")
    out = C.stored(rows.join(of_row, "digest").select(
        "doc_id", "k_row", "keep_id", "group_size",
        F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256")), "exact")
    index.append(verdict.filter("row IS NOT NULL").select(
        "digest", "keep_id", F.col("group_size").alias("n_rows")), batch)
    return out


def distinct_texts(docs: DataFrame, index: DigestIndex, *, id_col: str = "doc_id",
                   text_col: str = "text", batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that ``dedup`` keeps, with all their columns."""
    found = dedup(docs, index, id_col=id_col, text_col=text_col, batch=batch)
    same = found.groupBy(F.col("doc_id").alias("k_id"), "k_row").agg(
        F.count(F.lit(1)).alias("n_same"), F.max("kept").alias("any"))
    return C.semi_rows(docs, same.filter("any").drop("any"), id_col)
