"""Files that already landed."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.names import base_name

log = logging.getLogger(__name__)


def landing_manifest(spark: SparkSession, folder: str, suffix: str = ".zip") -> DataFrame:
    """Name, modification time, path and length of the files in a folder.

    Only the listing is read, never the files. A missing folder gives no rows but the same columns.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}")
    try:
        files = reader.load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no landing folder at %s", folder)
        files = spark.createDataFrame([], "path STRING, modificationTime TIMESTAMP, length BIGINT")
    return files.select(base_name(F.col("path")).alias("arquivo"),
                        F.col("modificationTime").alias("data_modificacao"), "path", "length")
