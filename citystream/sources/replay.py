"""Replay a table as a Kafka-shaped envelope stream on files.

Rows are range-partitioned by (event_time, event_id) into ``n_files``
JSON files written by Spark (no driver round trip), then the files'
modification times are set in partition order: the file stream source
reads oldest first, so ``maxFilesPerTrigger=1`` replays in event-time order.
"""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_envelope_files(records: DataFrame, fields: list[str], key: str, folder: str,
                         n_files: int) -> list[str]:
    env = (records.repartitionByRange(n_files, F.col("event_time").asc_nulls_first(), "event_id")
           .sortWithinPartitions(F.col("event_time").asc_nulls_first(), "event_id")
           .select(F.col(key).cast("string").alias("key"),
                   F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
                   "topic", "partition", "offset",
                   F.col("event_time").alias("timestamp")))
    env.write.mode("overwrite").json(folder)
    files = sorted(glob.glob(os.path.join(folder, "part-*.json")))
    base = 1_700_000_000
    for i, f in enumerate(files):
        os.utime(f, (base + i, base + i))
    return files
