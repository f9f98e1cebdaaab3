"""Incremental runs: sample requests as they arrive.

The request table is read as a file stream; each micro-batch (the requests
that arrived since the last one) runs the whole batch job of
``plans.job.run`` through ``foreachBatch``. The stream checkpoint records
which files were consumed, so a request file is sampled once even across
restarts. The job itself refuses a submission-year (per product line) that the
sample already holds, so neither a later batch nor a replayed one touches lists
that stand; a replayed batch rewrites its own status folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hybrid_sampling.plans import job as PL
from hybrid_sampling.schemas import SAMPLING_REQUEST
from hybrid_sampling.session import shared_dir


def sample_new_requests(
    spark: SparkSession,
    requests_dir: str,
    inputs_for: Callable[[DataFrame], PL.Inputs],
    sample_root: str,
    status_root: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start the stream. ``inputs_for(batch_requests)`` returns the run's
    inputs with ``requests`` set to the micro-batch. With ``available_now``
    the query processes what is there and stops (scheduled runs); otherwise it
    keeps polling for new files."""
    reader = spark.readStream.schema(SAMPLING_REQUEST)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    stream = reader.parquet(requests_dir)

    def one_batch(batch: DataFrame, epoch_id: int) -> None:
        # the job reads the batch's requests several times (filter, parse,
        # outcomes, status version): keep them for the batch's duration
        batch = batch.persist()
        try:
            inp = inputs_for(batch)
            out = f"{status_root.rstrip('/')}/epoch={epoch_id}"
            PL.run(inp, sample_root, f"{out}/requests", f"{out}/failures", status_mode="overwrite")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(one_batch).option(
        "checkpointLocation", checkpoint or f"{shared_dir(spark)}/stream-requests-checkpoint"
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
