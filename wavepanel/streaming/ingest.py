"""Incremental load of raw extract files as they arrive.

The file source's checkpoint records which files were already seen.  Each
micro-batch hands its new files to the batch loader, so the preamble, the
header and the records are read exactly as in a batch, and writes them to a
folder of its own; a repeated batch replaces that folder, so every file is in
the table once.  The panel operators themselves stay batch: sign verdicts and
tiles need every row of the panel.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wavepanel.sources.files import load_extracts

# Partition column of the target table: the micro-batch of a row.
BATCH = "ingest_batch"
# Columns of Spark's source of whole files.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def start_ingest(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                 checkpoint_location: str, preamble_prefix: str | None = "#",
                 timestamp_format: str | None = None, max_files_per_trigger: int = 1000,
                 available_now: bool = True) -> StreamingQuery:
    """Start the ingest stream; with ``available_now`` it processes what is
    there and stops (schedule it like a batch job).

    ``checkpoint_location`` belongs to the target: every run that appends to
    ``target_path`` must name the same one.  ``max_files_per_trigger`` bounds
    the file names of a batch.
    """
    if not checkpoint_location:
        raise ValueError("an ingest needs the checkpoint location of its target")
    # only the names are selected, so the source never opens the files
    names = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
             .option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir).select("path"))

    def load(batch, batch_id):
        files = [r["path"] for r in batch.collect()]
        if files:
            rows = load_extracts(batch.sparkSession, files, schema, preamble_prefix,
                                 timestamp_format=timestamp_format)
            rows.write.mode("overwrite").parquet(f"{target_path}/{BATCH}={batch_id}")

    w = (names.writeStream.foreachBatch(load)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingest_available(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                     checkpoint_location: str, **kw) -> None:
    """Run one catch-up ingest to completion."""
    q = start_ingest(spark, source_dir, schema, target_path, checkpoint_location, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
