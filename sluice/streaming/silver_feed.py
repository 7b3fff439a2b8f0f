"""Silver fed by what bronze gained since the last run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.loads import FINISHED
from sluice.plans.bronze import bronze_log
from sluice.plans.silver import SilverTables, load_silver

#: Age up to which the stream takes up a file of the log, in days: a file is never too old.
ANY_AGE = "365000d"


def feed_silver(spark: SparkSession, bronze_table: str, tables: SilverTables, checkpoint: str,
                extra_keys: Sequence[str] = ()) -> None:
    """Process all loads of bronze that have finished since the last run, then stop.

    The stream is bronze's log, one small file per load, which tells the months that changed; bronze's own files are
    neither listed nor dated. Versions are ranked over everything bronze holds for these months. A batch that is repeated
    after a failure adds nothing twice, because silver takes only versions it lacks.
    """

    def load_changed(batch: DataFrame, _: int) -> None:
        changed = batch.where(F.col("estado") == FINISHED).select(F.inline("meses")).distinct()
        months = [(row.ano, row.mes) for row in changed.collect()]  # as many as the calendar has at most
        if months:
            # In the caller's session: the stream has one of its own, and the caller's would not learn of the new files.
            load_silver(spark, bronze_table, tables, months, extra_keys)

    query = (spark.readStream.option("maxFileAge", ANY_AGE).table(bronze_log(bronze_table)).writeStream
             .foreachBatch(load_changed).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
