"""Stateless scoring on a stream.

The feature and quality projections are row-local, so the same column
expressions run unchanged on a ``readStream`` DataFrame.  The sink is a
parquet folder with a checkpoint, both under the shared checkpoint folder:
a restarted or retried micro-batch is written exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.functions import codegen as CG


def stream_quality(spark: SparkSession, source_dir: str, schema, text_col: str, id_col: str,
                   sink_dir: str, checkpoint_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Score every row arriving in ``source_dir``; process what is there, then stop.

    A micro-batch takes all files there are unless ``max_files_per_trigger`` bounds it.

    Returns the sink read back as a batch DataFrame.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    scored = stream.select(F.col(id_col), F.round(CG.code_quality(text_col), 6).alias("quality"))
    q = (scored.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(scored.schema).parquet(sink_dir)
