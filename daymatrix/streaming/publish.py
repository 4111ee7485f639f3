"""Publication of staged rows by a stream over the staging folder.

The stream only tells that files have arrived.  What is published are complete runs:
those whose writer has finished and that carry no mark of being published yet, the
marks lying beside the stream's checkpoint in place of clearing the runs.  A run whose
files arrive in several batches is thus published whole, and of each of its days the
latest run counts, also if an older one arrives late.  Whole days are replaced as in
any other publication, so a batch that is repeated after a failure changes nothing.
Files of published runs that are past the retention period go after each batch; a run
that arrives late with such a day replaces it, as its newer one is no longer staged.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from daymatrix.model import VALUES_SCHEMA
from daymatrix.plans.incremental import publish
from daymatrix.session import Folder, scratch
from daymatrix.sources.store import MatrixStore, StagingArea


def publish_available(
    spark: SparkSession,
    staging: StagingArea,
    store: MatrixStore,
    checkpoint: str,
    as_of: date,
    created_at: datetime,
    impute_until: date | None = None,
) -> None:
    """Publish all complete runs that were not published before, then stop."""
    marks = Folder(spark, f"{checkpoint.rstrip('/')}-published")

    def publish_runs() -> None:
        done = set(marks.names())
        news = [run for run in staging.runs() if f"run={run}" not in done]
        if news:
            with scratch(spark):
                publish(
                    store, staging, as_of, created_at,
                    impute_until=impute_until, clear=False, news=news,
                )
            for run in news:
                marks.touch(f"run={run}")
        # What is published may expire; runs that are not stay whole.
        staging.expire(as_of, runs=[name.removeprefix("run=") for name in marks.names()])

    def publish_batch(_batch: DataFrame, _: int) -> None:
        publish_runs()

    files = (
        spark.readStream.schema(f"{VALUES_SCHEMA}, run string")
        .option("basePath", staging.folder.path)
        .parquet(f"{staging.folder.path}/run=*")
    )
    query = (
        files.writeStream.foreachBatch(publish_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    publish_runs()  # runs whose writer finished after their files had been seen
