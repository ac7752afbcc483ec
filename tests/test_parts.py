"""Streams hold a bounded part at a time."""

from collections import namedtuple

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editflow import queries_lake
from editflow.operators.anomaly import Detector
from editflow.operators.windows import Slide
from editflow.streaming import monitor

D = "/root/testdata/sf0.001"
ALIVE = {"now": 0, "most": 0}


class Edit(namedtuple("Edit", "wiki page_title us event_id page_id user is_bot is_revert revision_id revert_target_revision_id byte_length_delta provenance_id")):
    def __new__(cls, *values):
        ALIVE["now"] += 1
        ALIVE["most"] = max(ALIVE.values())
        return super().__new__(cls, *values)

    def __del__(self):
        ALIVE["now"] -= 1


class Values(dict):
    """A MapState or a ValueState in memory."""

    containsKey, getValue, updateValue = dict.__contains__, dict.get, dict.__setitem__
    exists = lambda self: () in self
    get = lambda self, key=(): dict.get(self, key)
    update = lambda self, value: self.__setitem__((), value)


class Nothing:
    getCurrentWatermarkInMs = lambda self: 0
    registerTimer = deleteTimer = lambda self, at: None


def test_the_monitor_keeps_no_rows_of_a_batch():
    m = monitor.PageMonitor(Slide(3600, 600), Detector(), "long", T.StructType([T.StructField("kind", T.StringType())]))
    m.handle, m.buckets, m.history = Nothing(), Values(), Values()
    rows = (Edit("w", "p", 3_600_000_000 + i * 1_000_000, i, 7, f"u{i % 3}", i % 5 == 0, i % 2 == 0, i, i - 1, i % 4 - 2, f"n{i}") for i in range(2000))
    assert list(m.handleInputRows(("w", "p"), rows, Nothing())) == []
    assert ALIVE["most"] < 10
    assert sum(b[1] for b in m.buckets.values()) == 2000 and m.buckets[(3_600_000_000,)][7:11] == (4_199_000_000, 599, 599, "n599")
    more = iter([Edit("w", "p", 3_600_000_000, 5000, 7, "u9", True, False, 5000, None, -9, "x")])
    list(m.handleInputRows(("w", "p"), more, Nothing()))
    first = m.buckets[(3_600_000_000,)]
    assert first[1] == 601 and first[6] == ["u0", "u1", "u2", "u9"] and first[8] == 599 and len(first[11]) == 601


def test_parts_are_bounded_and_whole(spark):
    _, _, parts = queries_lake._parts(spark, D, 300)
    whole = [r.event_id for p in parts for r in p.collect()]
    assert len(parts) == -(-len(whole) // 300) > 2 and all(p.count() <= 330 for p in parts)
    assert len(whole) == len(set(whole)) == spark.read.parquet(f"{D}/events.parquet").count()
    ends = [p.agg(F.min("event_time"), F.max("event_time")).first() for p in parts]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("name, plain", [("stream_late_policy", "late_events")])
def test_more_parts_give_the_same_rows(spark, monkeypatch, name, plain):
    monkeypatch.setattr(queries_lake, "PART_ROWS", 400)
    got = {r.event_id: r.late for r in queries_lake.QUERIES[name](spark, D).collect()}
    assert got == {r.event_id: r.late for r in queries_lake.QUERIES[plain](spark, D).collect()}
