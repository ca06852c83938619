"""Procedure documents (our own wording) and the text-corpus source."""

from __future__ import annotations

import os
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Six short operating procedures, one per incident. Written for this engine;
# the document names match the incident names.
PROCEDURES = {
    "kitchen_delay": """Procedure: kitchen delay and kitchen bottleneck response.
Trigger: average preparation time above the kitchen target for ten minutes.
Step 1. The shift lead checks which kitchen station holds the longest ticket queue.
Step 2. Move a cook from a quiet station to the bottleneck station.
Step 3. Hide dishes with long preparation time from the online menu until the queue clears.
Step 4. Batch common components such as rice, sauces and bread ahead of demand.
Review: log prep time per station every fifteen minutes until it is back under target.
""",
    "courier_delay": """Procedure: courier delay and courier shortage response.
Trigger: delivery delay rate rising while kitchen preparation time stays normal.
Step 1. Dispatch checks the number of couriers online against open deliveries.
Step 2. Raise the courier incentive for the affected zone to bring riders online.
Step 3. Group nearby deliveries so one courier carries two orders to the same area.
Step 4. Offer overflow deliveries to a partner logistics fleet.
Review: track pickup wait time and the share of late deliveries each hour.
""",
    "weather_surge": """Procedure: weather surge during storms, heavy rain or heat.
Trigger: delays and cancellations climbing together while weather alerts are active.
Step 1. Shrink the delivery radius so couriers ride shorter distances.
Step 2. Switch on the weather surcharge and the rider weather bonus.
Step 3. Use sealed double packaging to keep food dry and warm.
Step 4. Tell customers the expected delay at checkout.
Review: watch rider speed and cancellation share until the weather clears.
""",
    "staff_shortage": """Procedure: staff shortage in the kitchen or at packing.
Trigger: stations running below planned headcount with preparation time rising.
Step 1. Move front of house staff to packing and assembly tables.
Step 2. Remove dishes that need several stations from the menu for the shift.
Step 3. Call in off duty staff with an overtime bonus.
Step 4. Re-plan breaks so every station keeps one trained person.
Review: compare staffed hours with the order forecast for the next shift.
""",
    "festival_rush": """Procedure: festival rush and holiday peak demand.
Trigger: order inflow far above the forecast during a festival or event.
Step 1. Add a short stagger between accepted orders on the aggregator apps.
Step 2. Pre-cook the most popular festival items in batches before the rush hour.
Step 3. Reduce the delivery zone to a compact radius around the store.
Step 4. Put an extra person on order handover to couriers.
Review: compare the festival rush volume with the plan after the peak.
""",
    "inventory_shortage": """Procedure: inventory shortage and out of stock items.
Trigger: cancellations caused by missing ingredients or items out of stock.
Step 1. Mark every out of stock item unavailable on all ordering apps.
Step 2. Offer a suitable substitute dish to customers before cancelling.
Step 3. Place an urgent order with a local supplier for the missing inventory.
Step 4. Count stock of the top twenty ingredients at the start of each shift.
Review: record which inventory items ran out and adjust reorder levels.
""",
}


def procedure_documents(spark: SparkSession) -> DataFrame:
    """``(doc_name, content)`` for the six procedures (a small dimension)."""
    return spark.createDataFrame(sorted(PROCEDURES.items()), "doc_name string, content string")


def write_procedures(folder: str) -> None:
    """Write the procedures as ``<name>.txt`` files (for the corpus reader)."""
    os.makedirs(folder, exist_ok=True)
    for name, text in PROCEDURES.items():
        with open(os.path.join(folder, f"{name}.txt"), "w", encoding="utf-8") as f:
            f.write(text)


def _named(files: DataFrame, *columns) -> DataFrame:
    stem = F.regexp_extract(F.col("path"), r"([^/]*)\.[^./]*$", 1)
    return files.select(stem.alias("doc_name"), "path", *columns)


def _contents(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(doc_name, path, content, valid) of the files whose bytes can be read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").load(folder)
             .select("path", F.col("content").cast("string").alias("content")))
    return _named(files, "content", F.is_valid_utf8("content").alias("valid"))


def read_corpus(spark: SparkSession, folder: str, pattern: str = "*.txt",
                warn: bool = True) -> DataFrame:
    """One row per text file, ``doc_name`` = file stem, ``content`` = the whole
    file. Files that cannot be read, or are no UTF-8, are left out; ``warn`` names
    the first of them in a warning, ``corpus_rejects`` has all."""
    if warn:
        bad = [r.doc_name for r in corpus_rejects(spark, folder, pattern).limit(20).collect()]
        if bad:
            warnings.warn(f"unreadable files in {folder}: {', '.join(bad)}", stacklevel=2)
    found = _contents(spark, folder, pattern).filter("valid").select("doc_name", "content")
    return found.unionByName(_empty_files(spark, folder, pattern))


def _empty_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Files without a byte, which Spark's readers pass over: documents without text."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, pattern)  # noqa: SLF001
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    paths = [(str(s.getPath()), "") for s in fs.globStatus(path) or [] if s.isFile() and s.getLen() == 0]
    return _named(spark.createDataFrame(paths, "path string, content string"), "content").drop("path")


def corpus_rejects(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(doc_name, path, error) of the files that ``read_corpus`` leaves out:
    ``unreadable`` when their bytes cannot be read, ``not_utf8`` otherwise. The list
    of all files comes from the file listing, which opens none."""
    listed = _named(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder))
    read = _contents(spark, folder, pattern).select(F.col("path").alias("p"), "valid")
    return (listed.join(read, F.col("path") == F.col("p"), "left")
            .filter(~F.coalesce("valid", F.lit(False)))
            .select("doc_name", "path",
                    F.when(F.col("p").isNull(), "unreadable").otherwise("not_utf8").alias("error")))
