"""New files of a folder as a stream: each is segmented once and appended."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import segment


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str, dialect: str = "bound", once: bool = True) -> StreamingQuery:
    """Segments text files that are new below ``folder`` into Parquet at ``out``; what was done before is remembered at ``checkpoint``."""
    raw = spark.readStream.option("recursiveFileLookup", True).option("wholetext", True).schema("value string").text(folder, wholetext=True)
    texts = raw.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))
    stream = segment.segment(texts, "path", "text", dialect).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start(out)
