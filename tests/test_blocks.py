"""Edits are packed into blocks before they meet at their page."""

import random

import pyarrow as pa
import pytest

from editflow import queries_lake
from editflow.streaming import blocks, monitor, streams

TYPES = [pa.string(), pa.string(), pa.int64(), None, pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def packed(rows, id_type=pa.int64()):
    columns = [pa.array(c, t or id_type) for c, t in zip(zip(*rows), TYPES)]
    return [tuple(r.values()) for r in blocks._blocks(pa.RecordBatch.from_arrays(columns, names=list(blocks.EDIT)), 100, 7).to_pylist()]


def test_a_page_sees_blocks_in_place_of_edits():
    rows = [("w", f"p{i % 2}", i, i, None if i < 50 else 7, "u", i % 5 == 0, False, i, None, i % 3 - 1, f"n{i}") for i in range(1000)]
    got = packed(rows)
    assert len(got) == 22 and sum(b[4] for b in got) == 1000
    assert [e for b in got for e in blocks.edits_of(b[3:]) if b[1] == "p1" and b[2] == 107] == [(i, i) for i in range(107, 207, 2)]
    assert [b[3:9] + b[10:14] for b in got if b[:3] == ("w", "p0", 7)] == [(7, 50, 10, 0, 1, 16, 106, 106, 106, "n106")]


@pytest.mark.parametrize("id_type", [pa.int64(), pa.string()])
def test_blocks_have_the_sums_and_pairs_of_their_edits(id_type):
    r = random.Random(3)
    for n in (1, 5, 60, 200):
        ids = [str(i) if id_type == pa.string() else i for i in range(n)]
        rows = [
            ("w", "p", r.choice([0, 5, 5, 40, 90, 250]), ids[i], r.choice([None, 1]), r.choice(["a", "b", "c", "", None]), r.choice([True, None]), r.choice([True, False, None]), r.choice([i, i // 2, None]), r.choice([None, *range(n)]), r.choice([None, -2, 3]), f"n{i}")
            for i in range(n)
        ]
        cut = r.randint(0, n)
        by_start = {}
        for half in (rows[:cut], rows[cut:]):
            for _, _, start, *block in packed(half, id_type) if half else []:
                by_start.setdefault(start, []).append(block)
        got = {start: blocks.joined(several) for start, several in by_start.items()}
        plain, written, undone = {}, {}, []
        for _, _, us, i, *rest in rows:
            plain.setdefault((us - 7) // 100 * 100 + 7, monitor.Bucket()).add(us, i, *rest)
        assert got.keys() == plain.keys()
        for start, bucket in plain.items():
            want = bucket.joined(None)
            assert got[start][0] == want[0] and got[start][1:6] == want[1:6] and got[start][7:11] == want[7:11] and sorted(got[start][6]) == want[6]
            for revision, *who in zip(*want[11:15]):
                if revision not in written or tuple(who[:2]) > written[revision][:2]:
                    written[revision] = tuple(who)
            undone += zip(*want[15:17])
        assert monitor.strongest(blocks.edges(list(got.values()))) == monitor.strongest_pair({k: v[2] for k, v in written.items()}, undone)


def test_python_state_has_partitions_by_cores(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert queries_lake._state_partitions(spark) == 8
        spark.range(9).selectExpr("timestamp_seconds(id + 1) AS event_time", "id AS event_id").write.parquet(str(tmp_path / "in"))
        stream = streams.dedupe(spark.readStream.schema("event_time timestamp, event_id long").parquet(str(tmp_path / "in")), 60)
        query = streams.run_to_end(stream, str(tmp_path / "checkpoint"), path=str(tmp_path / "out"), state_partitions=3)
        assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200" and spark.read.parquet(str(tmp_path / "out")).count() == 9
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
