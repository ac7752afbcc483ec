"""Spread summaries against plain ones, and the lake's statistics and retention on small tables."""

from datetime import datetime, timedelta

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import Window
from pyspark.sql import functions as F

from editflow.plans import audit
from editflow.sources import lake


def test_quantiles_are_those_of_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {"ties": rng.integers(-3, 4, 500) * 1.0, "wide": rng.normal(0, 1e6, 701), "one": np.array([-7.5]), "hot": np.full(300, 12.25)}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("ties", None), ("empty", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    found = {r["g"]: r for r in audit.quantiles(df, F.col("x"), (0.0, 0.5, 0.95, 1.0), ("g",)).collect()}
    for g, xs in groups.items():
        r = found[g]
        assert r["count"] == len(xs) and np.allclose([r.q0, r.q1, r.q2, r.q3], np.quantile(xs, [0, 0.5, 0.95, 1])) and np.isclose(r["mean"], xs.mean())
    assert found["ties"]["rows"] == 501 and found[None]["q1"] == 3.0
    assert found["empty"]["count"] == 0 and found["empty"]["q1"] is None and found["empty"]["max"] is None


def test_summaries_of_nothing_are_one_row(spark):
    none = spark.createDataFrame([], "ingestion_latency_ms double, compute_latency_ms double, e2e_latency_ms double")
    assert audit.latency_summary(none).first().sampled_events == 0
    r = audit.summarize(none, F.col("e2e_latency_ms")).first()
    assert r["count"] == 0 and r["p50"] is None


def test_late_events_in_runs_of_any_length(spark):
    start = datetime(2024, 1, 1)
    rows = [(p, o, start + timedelta(seconds=(o * 37 % 100) * 60 + o)) for p in (0, 1, None) for o in range(200)]
    df = spark.createDataFrame(rows, "partition int, offset long, event_time timestamp")
    seen = F.max("event_time").over(Window.partitionBy("partition").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1))
    plain = df.select("partition", "offset", F.coalesce(F.unix_micros("event_time") < F.unix_micros(seen) - 600_000_000, F.lit(False)).alias("late"))
    want = sorted(map(str, plain.collect()))
    assert any("late=True" in r for r in want)
    for run in (1, 7, 64, 1 << 16):
        assert sorted(map(str, audit.late_events(df, 600, run=run).select("partition", "offset", "late").collect())) == want


def test_throughput_goes_on_over_days(spark):
    at = [datetime(2024, 1, 1, 23, 59, 50), datetime(2024, 1, 2), datetime(2024, 1, 4), datetime(2024, 1, 4, 0, 0, 4)]
    rows = [("a", t, n) for t, n in zip(at, (10, 30, 172830, 172850))] + [(None, at[0], 1), (None, at[1], 2)]
    df = spark.createDataFrame(rows, "component string, recorded_at timestamp, events_parsed long")
    found = {(r.component, r.recorded_at): r.throughput for r in audit.throughput_between_reports(df).collect()}
    assert [found["a", t] for t in at] == [None, 2.0, 1.0, 5.0]
    assert [found[None, t] for t in at[:2]] == [None, 0.1]


def _edits(spark):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame([(i, start + timedelta(minutes=7 * i), f"wiki {i % 2}") for i in range(400)], "event_id long, event_time timestamp, wiki string")


def test_column_stats_are_those_of_the_footers(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_lake(_edits(spark), path)
    metas = [pq.read_metadata(p) for p in (tmp_path / "lake").rglob("*.parquet")]
    chunks = [m.row_group(i).column(j) for m in metas for i in range(m.num_row_groups) for j in range(m.num_columns)]
    r = lake.column_stats(spark, path).first()
    assert (r.files, r["rows"]) == (len(metas), 400)
    assert (r.column_bytes, r.compressed_bytes) == (sum(c.total_uncompressed_size for c in chunks), sum(c.total_compressed_size for c in chunks))
    assert r.ratio == round(r.column_bytes / r.compressed_bytes, 3)
    j = lake.json_reduction(lake.read_lake(spark, path, ["event_id", "wiki"])).first()
    assert j.json_bytes == sum(len(f'{{"event_id":{i},"wiki":"wiki {i % 2}"}}') + 1 for i in range(400))


def test_retain_divides_only_the_cutoffs_folders(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = _edits(spark)
    lake.write_lake(rows, path)
    files = {p for p in (tmp_path / "lake").rglob("*.parquet")}
    cutoff = datetime(2024, 1, 1, 10, 30)
    for _ in range(2):  # the second time it finds nothing to do
        lake.retain(spark, path, cutoff)
        left = {r.event_id: r.wiki for r in lake.read_lake(spark, path, ["event_id", "wiki"]).collect()}
        assert left == {i: f"wiki {i % 2}" for i in range(400) if datetime(2024, 1, 1) + timedelta(minutes=7 * i) >= cutoff}
    now = {p for p in (tmp_path / "lake").rglob("*.parquet")}
    assert {p.parent.name for p in now - files} == {"hour=10"}
    assert all(p.parent.name == "hour=10" or str(p.parent.parent.name) == "date=2024-01-01" for p in files - now)
