"""Incremental enrichment: new content files are annotated as they arrive.

The batch job marks its remaining work by a NULL index date (or a ledger of
done ids).  On files, the streaming source's checkpoint *is* that ledger:
each file is taken exactly once.  Every micro-batch runs the same body
pipeline (``jobs.enrich_body``) and overwrites its own ``epoch=<id>`` folder,
so a batch retried after a lost executor or driver rewrites the same output
instead of appending twice.  The checkpoint and output must live on shared
storage (the cluster's ``spark.checkpoint.dir``), never on a local disk.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docweave.operators import select
from docweave.plans import jobs


def enrich_stream(spark: SparkSession, source_dir: str, schema: StructType, out_dir: str,
                  source_lookup: DataFrame | None = None, checkpoint: str | None = None,
                  min_size: int | None = 1000, max_size: int | None = 100000,
                  files_per_batch: int = 100, params: jobs.BodyParams | None = None,
                  available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination`` it)."""
    # beside the output: a later session goes on where this one stopped
    checkpoint = checkpoint or os.path.join(out_dir, "_checkpoint")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(source_dir))

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        df = select.with_source(batch, source_lookup) if source_lookup is not None else batch
        df = select.filter_size(df, "structure_size", min_size, max_size)
        rows = jobs.enrich_body(df, "id", "body_text", params)
        (rows.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite").format(fmt)
         .save(os.path.join(out_dir, f"epoch={epoch_id}")))

    writer = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
