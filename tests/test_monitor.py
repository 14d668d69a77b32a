"""Live lag and throughput from progress reports; the audit of recovered state."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from test_streaming import METER_FIELDS, SF, stage, stream_of

from citystream import schemas
from citystream.session import checkpoint_location
from citystream.sources import testdata as td
from citystream.streaming import jobs, monitor


def test_offsets_of_topics_and_files():
    kafka = {"description": "KafkaV2", "numInputRows": 7, "startOffset": '{"t":{"0":1,"1":2}}', "endOffset": '{"t":{"0":5,"1":5}}',
             "latestOffset": '{"t":{"0":9,"1":5,"2":4}}'}
    assert monitor.offset_rows("g", 3, "x", kafka) == [("g", 3, "x", "t", 0, 1, 5, 9, 7), ("g", 3, "x", "t", 1, 2, 5, 5, 0),
                                                       ("g", 3, "x", "t", 2, None, None, 4, 0)]
    files = {"description": "Files[f]", "numInputRows": 2, "startOffset": None, "endOffset": '{"logOffset":1}', "latestOffset": None}
    assert monitor.offset_rows("g", 0, "x", files) == [("g", 0, "x", "Files[f]", 0, None, 1, 1, 2)]
    assert monitor.offset_rows("g", 0, "x", {"description": "d", "numInputRows": 0}) == []


def _topic_like():
    class TopicLike(DataSource):
        """Three partitions of 100, 200 and 300 messages, of which a group may read up to ``upto`` each."""

        @classmethod
        def name(cls):
            return "topic_like"

        def schema(self):
            return "partition int, offset long"

        def streamReader(self, schema):
            upto = int(self.options["upto"])

            class Reader(DataSourceStreamReader):
                def initialOffset(self):
                    return {"signals": {"0": 0, "1": 0, "2": 0}}

                def latestOffset(self):
                    return {"signals": {str(p): min(upto, 100 * (p + 1)) for p in range(3)}}

                def partitions(self, start, end):
                    return [InputPartition((int(p), start["signals"][p], end["signals"][p])) for p in end["signals"]]

                def read(self, partition):
                    p, a, b = partition.value
                    return iter([(p, o) for o in range(a, b)])

            return Reader()

    return TopicLike  # local, so that it travels by value


def test_lag_of_a_slowed_group_is_its_backlog(spark, tmp):
    spark.dataSource.register(_topic_like())
    root = os.path.join(tmp, "offsets")
    log = monitor.OffsetLog(spark, root)
    spark.streams.addListener(log)
    try:
        for group, upto in (("HIGH_PRIORITY", 1000), ("STANDARD_PRIORITY", 120)):
            rows = spark.readStream.format("topic_like").option("upto", upto).load()
            q = rows.writeStream.queryName(group).option("checkpointLocation", os.path.join(tmp, group)).format("noop").start()
            q.processAllAvailable()
            q.stop()
        groups = spark.createDataFrame([("HIGH_PRIORITY",), ("STANDARD_PRIORITY",), ("IDLE",)], "group_id string")
        end = time.time() + 30
        while time.time() < end and len([d for d in (os.listdir(root) if os.path.exists(root) else []) if d.startswith("run=")]) < 2:
            time.sleep(0.5)
        time.sleep(2)
        offsets = monitor.read_offsets(spark, root)
        lag = {r.group_id: r.lag for r in monitor.live_lag(offsets, groups).collect()}
        assert lag == {"HIGH_PRIORITY": 0, "STANDARD_PRIORITY": 80 + 180, "IDLE": None}
        assert {r.group_id: r.messages for r in monitor.group_throughput(offsets).collect()} == {"HIGH_PRIORITY": 600, "STANDARD_PRIORITY": 340}
    finally:
        spark.streams.removeListener(log)


def test_audit_of_a_restarted_query(spark, tmp):
    """After a restart the checkpoint holds what its source says; against a source without one batch it doesn't."""
    meters = td.smart_meters(spark, SF)
    src, name = os.path.join(tmp, "meters"), f"audit_{os.path.basename(tmp)}"
    rest = stage(meters, METER_FIELDS, "ward_id", src, 4, write=[0, 1])
    for more in (lambda: None, rest):
        more()
        # A long delay keeps many windows open.
        jobs.ward_energy_query(stream_of(spark, src, schemas.SMART_METERS), os.path.join(tmp, "h"), "json", os.path.join(tmp, "t"),
                               delay="20 days", name=name).trigger(availableNow=True).start().awaitTermination()
    place = checkpoint_location(spark, name)
    assert spark.read.format("statestore").load(place).count() > 300
    assert monitor.audit_ward_state(spark, place, meters).count() == 0
    skipped = sorted(os.listdir(src))[3]
    gone = {json.loads(json.loads(line)["value"])["timestamp"] for line in open(os.path.join(src, skipped))}
    found = monitor.audit_ward_state(spark, place, meters.where(~F.col("timestamp").isin(sorted(gone))))
    assert found.count() > 100
