"""The same workflow over documents that keep arriving.

The rules look at one document at a time and hold no state, so a streaming table
needs no watermark and no state store: the batch plan is used as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from caseloom.plans.workflow import load_texts, process_documents


def write_cases(
    arrivals: DataFrame, output_dir: str, checkpoint_dir: str, *, once: bool = False
) -> StreamingQuery:
    """Append the cases of a streaming table of ``source_file, text`` to parquet.

    ``once`` works through what has arrived so far and stops.
    """
    writer = (
        process_documents(load_texts(arrivals))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
