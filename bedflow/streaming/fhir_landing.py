"""Incremental bulk FHIR ingest over a landing folder.

New text files (one JSON document per line) are picked up by a Structured
Streaming file source; each micro-batch is shredded by the batch ingest
(``operators.fhir.bulk_ingest``) into its own partition of the resource and
child tables.  The streaming checkpoint records which files are done, so a
restarted or failed query resumes without re-ingesting them.  It lives in
the shared folder the cluster names in ``spark.checkpoint.dir``.  A batch
that fails half-way is replayed under the same id and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bedflow.operators.fhir import CHILD_TABLES, bulk_ingest
from bedflow.session import shared_dir


def start_landing_ingest(spark: SparkSession, landing_dir: str, target_dir: str,
                         name: str = "fhir_landing", available_now: bool = True,
                         max_files_per_trigger: int = 1000) -> StreamingQuery:
    checkpoint = f"{shared_dir(spark)}/streams/{name}"
    docs = (spark.readStream.format("text")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(landing_dir)
            .withColumnRenamed("value", "file_row"))

    def ingest(batch: DataFrame, batch_id: int) -> None:
        bulk_ingest(batch, target_dir, CHILD_TABLES, batch_id=f"{name}-{batch_id}")

    writer = docs.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(ingest)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
