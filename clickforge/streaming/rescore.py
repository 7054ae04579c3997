"""M-RESCORE on arriving files: a saved model scores feature-snapshot files
as they land, written as submission CSV.

The reference has no streaming operator; this is its "load the saved model
and score the test snapshot" step run as a Structured Streaming query.
The model transform is stateless, so every micro-batch is independent; the
checkpoint folder (shared storage) gives exactly-once output files.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickforge.models.gbt import score
from clickforge.sources.store import submission_frame


def scored_stream(spark: SparkSession, model_path: str, source_dir: str, schema: T.StructType,
                  predictors, id_col: str = "click_id") -> DataFrame:
    """Streaming DataFrame ``click_id, is_attributed`` over snapshot files."""
    model = PipelineModel.load(model_path)
    stream = spark.readStream.schema(schema).parquet(source_dir)
    return submission_frame(score(model, stream, predictors), "p", id_col)


def run_rescore(spark: SparkSession, model_path: str, source_dir: str, schema: T.StructType, predictors,
                out_dir: str, checkpoint_dir: str, available_now: bool = True, id_col: str = "click_id"):
    """Start the query; with ``available_now`` it processes every file present
    and stops (batch-like catch-up), otherwise it keeps running."""
    q = (scored_stream(spark, model_path, source_dir, schema, predictors, id_col)
         .writeStream.format("csv").option("header", True)
         .option("checkpointLocation", checkpoint_dir))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start(out_dir)
