"""Lines found in many documents, by levelled sorted runs of line hashes
(operator 13). DataFrame functions only.

A line's key is the line without white space at both ends, A-Z lower-cased; it is
known by a 128-bit hash. ``LineRuns`` is a table of runs: a run holds, sorted by
hash and bucketed by it, how many documents of some consecutive batches have each
line. A new batch is reduced to its own counts, loses by a merge anti-join those
lines that the runs already know to be settled (found in ``settled`` documents:
more would change nothing) and is added as a run of its own. When ``fanout`` runs
of a level lie side by side they are merged into one of the next level, so a batch
meets few runs, and a line is rewritten once per level.

A run is named by the batches it covers. It counts once its marker is written,
which happens after its files are; a run covered by a wider one is left out. A
batch added again, a lost job and a merge that stopped half-way therefore change
nothing. Readers open a run table by its path.

``drop_common_lines`` counts all documents in a few batches, takes the keys that
enough documents have, and cuts their lines out of every text: line hashes meet the
common keys by a join whose skewed partitions Spark splits, the line numbers to drop
are gathered per document, and a text is shuffled once.

Null and empty texts are one empty line. A line without key (white space alone)
stays if ``min_chars`` is above 0. Rows count as documents of their own, also when
they share a doc_id or are equal; a document counts once for a line that it holds
several times. A document that loses all its lines keeps an empty text. Very long
texts are handled whole. Other columns, whatever their names, take no part; an
empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaywatch.llm import common as C

SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_DOCS = 1, 10
BATCHES, FANOUT = 4, 3
BUCKET_ROWS = 250_000  # rows of a run's bucket, about
MAX_BUCKETS = 100_000


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def folded(s: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    ascii_only = F.octet_length(s) == F.char_length(s)
    return F.when(ascii_only, F.lower(s)).otherwise(F.translate(s, UPPER, LOWER))


def hashes(value: Column) -> list[Column]:
    """128 bits: two 64-bit hashes with different seeds."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("second"), value).alias("h2")]


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return C.pairs_of(docs, id_col, text_col)


def lines_of(text) -> Column:
    return F.split(F.col(text), "\n")


def line_counts(docs: DataFrame, batch: Column | None = None, *, id_col: str = "doc_id",
                text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, n): in how many documents each key is; with ``batch``, an
    expression over ``doc_id`` and ``text``, per batch. Counts are summed in each
    task before they are shuffled, so a line of all documents makes a row per task."""
    rows = texts_of(docs, id_col, text_col).select(
        (F.lit(0) if batch is None else batch).alias("batch"),
        F.explode(F.array_distinct(F.transform(F.transform(lines_of("text"), stripped), folded)))
        .alias("key"))
    return (rows.filter(F.char_length("key") >= min_chars).select("batch", *hashes(F.col("key")))
            .groupBy("batch", "h1", "h2").agg(F.count(F.lit(1)).alias("n")))


class LineRuns:
    """Runs of (h1, h2, n) in a bucketed, sorted table partitioned by run."""

    def __init__(self, spark: SparkSession, path: str, *, buckets: int, settled: int = MIN_DOCS,
                 fanout: int = FANOUT):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.settled, self.fanout = settled, fanout
        self.name = "line_runs_" + C.scratch(spark, "x").rsplit("-", 1)[1]
        spark.sql(f"CREATE TABLE {self.name} (h1 long, h2 long, n long, run string) USING parquet "
                  f"PARTITIONED BY (run) CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                  f"INTO {buckets} BUCKETS LOCATION '{self.path}/runs'")
        path_of = spark._jvm.org.apache.hadoop.fs.Path  # noqa: SLF001
        self._path = lambda name: path_of(f"{self.path}/{name}")
        self._fs = self._path("x").getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
        for folder in ("runs", "done"):
            self._fs.mkdirs(self._path(folder))
        spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def covered(self) -> list[tuple[int, int]]:
        """First and last batch of each complete run that no wider one covers."""
        done = sorted(tuple(map(int, s.getPath().getName().split("-")))
                      for s in self._fs.listStatus(self._path("done")))
        return [r for r in done
                if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in done)]

    def read(self, runs: list[tuple[int, int]] | None = None) -> DataFrame:
        """(h1, h2, n) of the given runs, all live ones by default; a key has a row
        in each run that counted it. A task reads the same bucket of all runs."""
        names = [f"{a}-{b}" for a, b in (self.covered() if runs is None else runs)]
        return self.spark.table(self.name).filter(F.col("run").isin(names)).drop("run")

    def totals(self, runs: list[tuple[int, int]] | None = None) -> DataFrame:
        """(h1, h2, n) merged over runs, in their bucketing: nothing is shuffled."""
        return self.read(runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def _write(self, rows: DataFrame, run: tuple[int, int]) -> None:
        name = f"{run[0]}-{run[1]}"
        self._fs.delete(self._path(f"runs/run={name}"), True)  # of an attempt without marker
        (rows.select("h1", "h2", "n", F.lit(name).alias("run")).sortWithinPartitions("h1", "h2")
         .write.insertInto(self.name))
        self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.name)
        self._fs.mkdirs(self._path(f"done/{name}"))

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """The lines of a batch that the runs do not know to be settled."""
        known = self.totals().filter(F.col("n") >= self.settled)
        return (counts.repartition(self.buckets, "h1", "h2").hint("merge")
                .join(known, ["h1", "h2"], "left_anti"))

    def add(self, counts: DataFrame, batch: int) -> None:
        """Add the counts of batch number ``batch`` (0, 1, ...; one added before is
        left as it is), then merge runs that have become many."""
        if any(a <= batch <= b for a, b in self.covered()):
            return
        self._write(self.unsettled(counts.select("h1", "h2", "n")), (batch, batch))
        self.compact()

    def compact(self) -> None:
        """Merge ``fanout`` neighbours of one level until no level has that many."""
        while True:
            runs = self.covered()
            level = [round(math.log(b - a + 1, self.fanout), 6) for a, b in runs]
            for i in range(len(runs) - self.fanout + 1):
                group = runs[i:i + self.fanout]
                if len(set(level[i:i + self.fanout])) == 1 and all(
                        x[1] + 1 == y[0] for x, y in zip(group, group[1:])):
                    self._write(self.totals(group), (group[0][0], group[-1][1]))
                    break
            else:
                return

    def detach(self) -> None:
        """Forget the name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def common_keys(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES
                ) -> DataFrame:
    """(h1, h2) of the keys found in at least ``min_docs`` documents, all documents
    taken through the runs in ``batches`` batches."""
    spark = docs.sparkSession
    deal = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")
    path = C.scratch(spark, "line-counts")
    line_counts(docs, deal, id_col=id_col, text_col=text_col, min_chars=min_chars).write.partitionBy(
        "batch").parquet(path)
    counts = spark.read.schema("h1 long, h2 long, n long, batch int").parquet(path)
    buckets = min(MAX_BUCKETS, max(1, math.ceil(counts.count() / BUCKET_ROWS)))
    runs = LineRuns(spark, C.scratch(spark, "line-runs"), buckets=buckets, settled=min_docs)
    for b in range(batches):
        runs.add(counts.filter(F.col("batch") == b), b)
    found = C.stored(runs.totals().filter(F.col("n") >= min_docs).select("h1", "h2"), "common-lines")
    runs.detach()
    return found


def drop_common_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      batches: int = BATCHES) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_text."""
    common = common_keys(docs, id_col=id_col, text_col=text_col, min_chars=min_chars,
                         min_docs=min_docs, batches=batches)
    texts = texts_of(docs, id_col, text_col)
    key = [F.col("doc_id"), F.xxhash64("text").alias("t1"),
           F.xxhash64(F.lit("second"), "text").alias("t2")]
    lines = texts.select(*key, F.posexplode(lines_of("text")).alias("pos", "line"))
    lines = lines.withColumn("line", stripped(F.col("line"))).filter(
        F.char_length("line") >= min_chars).select(
            "doc_id", "t1", "t2", "pos", *hashes(folded(F.col("line"))))
    # Equal rows have equal lines, which a set keeps once.
    gone = (lines.join(common, ["h1", "h2"]).groupBy("doc_id", "t1", "t2")
            .agg(F.collect_set("pos").alias("gone"))
            .select(F.col("doc_id").alias("g_id"), F.col("t1").alias("g1"), F.col("t2").alias("g2"),
                    "gone"))
    rows = texts.select(*key, lines_of("text").alias("lines")).join(
        gone, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("t1") == F.col("g1"))
        & (F.col("t2") == F.col("g2")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.transform(left, lambda i: F.get(F.col("lines"), i)))
    return rows.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                       F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
                       .alias("n_dropped"),
                       F.array_join(kept, "\n").alias("kept_text"))
