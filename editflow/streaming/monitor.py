"""Pages under watch: one keyed state for windows, anomalies, edit wars, late rows and eviction.

A page's state has each edit once, in the bucket of one slide that it falls in:
sums, the set of editors, who wrote which revision, and who undid which.  Edits
come as blocks, packed where they are read (see blocks).  A timer stands at the next end of a window.  When the watermark has passed it,
the windows that have ended are put together from their buckets, judged against
the page's history, searched for mutual reverts, and reported once; buckets that
no open window needs go.  A page whose last window can no longer matter to any
later one is evicted with all its state, and says so.

What comes for windows that have all been reported is late: it changes nothing,
and is reported as a row of its own instead of being dropped unseen.
"""

from __future__ import annotations

import statistics
from collections import Counter
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.anomaly import Detector
from ..operators.conflict import ConflictRule
from ..operators.windows import Slide
from . import blocks

WINDOW, LATE, EVICTED = "window", "late", "evicted"


def check_ttl(slide: Slide, watermark_seconds: int, ttl_seconds: int) -> None:
    """History must outlive a window and its watermark, else a live page could lose it."""
    if ttl_seconds < least_ttl(slide, watermark_seconds):
        raise ValueError(f"history ttl of {ttl_seconds} s is shorter than window plus watermark, {least_ttl(slide, watermark_seconds)} s")


def least_ttl(slide: Slide, watermark_seconds: int) -> int:
    return slide.size + watermark_seconds


def strongest_pair(authors: dict[int, str], undone: list[tuple[str, int]]) -> tuple[int, str | None, str | None]:
    """(mutual reverts, editor, editor) of the pair that reverted each other most; of ties the smallest names."""
    return strongest(Counter((src, authors[target]) for src, target in undone if authors.get(target) and authors[target] != src))


def strongest(edges: Counter) -> tuple[int, str | None, str | None]:
    """strongest_pair of how often (editor, editor) the first undid the second."""
    pairs = [(-(n + edges[b, a]), a, b) for (a, b), n in edges.items() if a < b and (b, a) in edges]
    if not pairs:
        return 0, None, None
    n, a, b = min(pairs)
    return -n, a, b


def judge(count: float, history: list[float], d: Detector) -> tuple[str, float, float]:
    """(anomaly_type, anomaly_score, threshold_used) of a window's count against the counts before it."""
    if len(history) < d.min_history:
        return ("count_fallback" if count >= d.fallback_count else "none"), float(count), float(d.fallback_count)
    median = statistics.median(history)
    spread = statistics.median([abs(x - median) for x in history])
    score = 0.6745 * (count - median) / max(spread, d.mad_floor)
    return ("median_mad" if score >= d.threshold else "none"), score, d.threshold


class Bucket:
    """What a batch adds to a bucket."""

    def __init__(self) -> None:
        self.page, self.n, self.bots, self.reverts, self.delta, self.losses = None, 0, 0, 0, 0, 0
        self.editors: set[str] = set()
        self.newest: tuple | None = None  # time, id, revision and provenance
        self.revisions, self.times, self.ids, self.authors, self.undoers, self.targets = [], [], [], [], [], []

    def add(self, us, event_id, page_id, user, is_bot, is_revert, revision_id, target, delta, provenance) -> None:
        if self.page is None:
            self.page = page_id
        self.n += 1
        self.bots += bool(is_bot)
        self.reverts += bool(is_revert)
        if delta:
            self.delta += delta
            self.losses += delta < 0
        if user:
            self.editors.add(user)
        if self.newest is None or (us, event_id) > self.newest[:2]:
            self.newest = us, event_id, revision_id, provenance
        if revision_id is not None:
            self.revisions.append(revision_id)
            self.times.append(us)
            self.ids.append(event_id)
            self.authors.append(user)
        if is_revert and user and target is not None:
            self.undoers.append(user)
            self.targets.append(target)

    def joined(self, old: tuple | None) -> tuple:
        """The bucket's state with this added to what it was."""
        page, n, bots, reverts, delta, losses, editors, *newest, revisions, times, ids, authors, undoers, targets = old or (None, 0, 0, 0, 0, 0, [], None, None, None, None, [], [], [], [], [], [])
        last = self.newest if newest[0] is None or self.newest[:2] > tuple(newest[:2]) else newest
        sums = n + self.n, bots + self.bots, reverts + self.reverts, delta + self.delta, losses + self.losses
        lists = [*revisions, *self.revisions], [*times, *self.times], [*ids, *self.ids], [*authors, *self.authors], [*undoers, *self.undoers], [*targets, *self.targets]
        return self.page if page is None else page, *sums, sorted(self.editors.union(editors)), *last, *lists


class PageMonitor(StatefulProcessor):
    """State of a page by MapState (bucket -> its edits) and ValueState (history); times are microseconds, timers milliseconds of event time.  Takes edits one by one."""

    BUCKET = (
        "page_id long, n long, bots long, reverts long, delta long, losses long, editors array<string>, last_time long, last_id {0}, last_revision long, provenance string, "
        "revisions array<long>, times array<long>, ids array<{0}>, authors array<string>, undoers array<string>, targets array<long>"
    )

    def __init__(self, slide: Slide, detector: Detector, id_type: str, output: T.StructType):
        if slide.size % slide.slide:
            raise ValueError("a window must be a whole number of slides")
        self.size, self.slide, self.offset = slide.size * 1_000_000, slide.slide * 1_000_000, slide.offset * 1_000_000
        self.detector, self.id_type = detector, id_type
        self.row = Row(*output.names)
        self.blank = dict.fromkeys(output.names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getMapState("buckets", "start long", self.BUCKET.format(self.id_type))
        #: counts of the last windows, start of the last one, time of the newest edit, time of the timer
        self.history = handle.getValueState("history", "counts array<double>, last long, last_edit long, timer long")

    def _take(self, key: Any, rows: Iterator[Row], closed: int, new: dict[int, Any]) -> Iterator[Row]:
        """Add rows to the new buckets, and report those that are late."""
        names: dict[str | None, str | None] = {}  # a name is kept once, a row not at all
        for _, _, us, event_id, page_id, user, *rest in rows:
            start = (us - self.offset) // self.slide * self.slide + self.offset
            if start + self.size <= closed:
                yield self._report(kind=LATE, wiki=key[0], page_title=key[1], event_id=event_id, event_time=us)
                continue
            if start not in new:
                new[start] = Bucket()
            new[start].add(us, event_id, page_id, names.setdefault(user, user), *rest)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        new: dict[int, Any] = {}
        yield from self._take(key, rows, closed, new)
        if not new:
            return
        newest = max(bucket.newest[0] for bucket in new.values())
        for start, bucket in new.items():
            old = self.buckets.getValue((start,)) if self.buckets.containsKey((start,)) else None
            self.buckets.updateValue((start,), bucket.joined(old))
        counts, last, last_edit, timer = self.history.get() if self.history.exists() else ([], None, None, None)
        last_edit = newest if last_edit is None else max(last_edit, newest)
        # the first window of the earliest bucket that hasn't been reported
        first = min(new) + self.slide
        if first <= closed:
            first += ((closed - first) // self.slide + 1) * self.slide
        timer = self._wait(timer, first)
        self.history.update((counts, last, last_edit, timer))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.history.exists():
            return
        counts, last, last_edit, timer = self.history.get()
        if timer is None or expiredTimerInfo.getExpiryTimeInMs() * 1000 < timer:
            return  # an earlier one has taken its place
        d = self.detector
        buckets = {k[0]: v for k, v in self.buckets.iterator()}
        ends = sorted({end for b in buckets for end in range(b + self.slide, b + self.size + 1, self.slide) if timer <= end <= closed})
        for end in ends:
            parts = [buckets[b] for b in range(end - self.size, end, self.slide) if b in buckets]
            start = end - self.size
            if d.ttl_seconds is not None and last is not None and start - last >= d.ttl_seconds * 1_000_000:
                counts = []
            row = self._window(parts)
            kind, score, limit = judge(row["edit_count"], counts, d)
            yield self._report(kind=WINDOW, wiki=key[0], page_title=key[1], window_start=start, window_end=end, anomaly_type=kind, anomaly_score=score, threshold_used=limit, history_size=len(counts), **row)
            counts, last = [*counts, float(row["edit_count"])][-d.history :], start
        for b in [b for b in buckets if b + self.size <= closed]:
            self.buckets.removeKey((b,))
            del buckets[b]
        if buckets:
            following = min(end for b in buckets for end in range(b + self.slide, b + self.size + 1, self.slide) if end > closed)
        elif d.ttl_seconds is None:
            self.history.update((counts, last, last_edit, None))
            return
        else:  # no edit that is still to come in time has a window this near to the last one
            following = last + d.ttl_seconds * 1_000_000 + self.size
            if following <= closed:
                yield self._report(kind=EVICTED, wiki=key[0], page_title=key[1], event_time=last_edit)
                self.history.clear()
                self.buckets.clear()
                return
        self.history.update((counts, last, last_edit, self._wait(None, following)))

    def _wait(self, timer: int | None, at: int) -> int:
        """Set the timer, in place of a later one."""
        if timer is not None and timer <= at:
            return timer
        if timer is not None:
            self.handle.deleteTimer(-(-timer // 1000))
        self.handle.registerTimer(-(-at // 1000))
        return at

    def _report(self, **values: Any) -> Row:
        found = self.blank | values
        for name in ("window_start", "window_end", "event_time"):
            if found[name] is not None:
                found[name] = datetime.fromtimestamp(found[name] // 1_000_000, timezone.utc).replace(microsecond=found[name] % 1_000_000)
        return self.row(*found.values())

    @staticmethod
    def _mutual(parts: list[tuple]) -> tuple[int, str | None, str | None]:
        written: dict[int, tuple] = {}
        for p in parts:
            for revision, *who in zip(p[11], p[12], p[13], p[14]):
                if revision not in written or tuple(who[:2]) > written[revision][:2]:
                    written[revision] = tuple(who)
        return strongest_pair({k: v[2] for k, v in written.items()}, [x for p in parts for x in zip(p[15], p[16])])

    def _window(self, parts: list[tuple]) -> dict[str, Any]:
        total = lambda i: sum(p[i] for p in parts)
        newest = max((p for p in parts), key=lambda p: (p[7], p[8]))
        mutual, a, b = self._mutual(parts)
        return {
            "page_id": next((p[0] for p in parts if p[0] is not None), None), "edit_count": total(1), "unique_editors": len({e for p in parts for e in p[6]}), "human_edits": total(1) - total(2), "bot_edits": total(2),
            "revert_count": total(3), "net_byte_delta": total(4), "edit_burst_count": total(5), "last_revision_id": newest[9], "provenance_id": newest[10], "mutual_revert_count": mutual, "editor_a": a, "editor_b": b,
        }


class _Blocks(list):
    """Blocks that a batch adds to a bucket."""

    @property
    def newest(self) -> tuple:
        return max(block[7:9] for block in self)

    def joined(self, old: tuple | None) -> tuple:
        return blocks.joined(self if old is None else [old, *self])


class BlockMonitor(PageMonitor):
    """A PageMonitor that takes edits as blocks, and keeps each bucket as one."""

    BUCKET = blocks.FIELDS

    def _take(self, key: Any, rows: Iterator[Row], closed: int, new: dict[int, Any]) -> Iterator[Row]:
        for _, _, start, *block in rows:
            if start + self.size <= closed:
                for event_id, us in blocks.edits_of(block):
                    yield self._report(kind=LATE, wiki=key[0], page_title=key[1], event_id=event_id, event_time=us)
            else:
                new.setdefault(start, _Blocks()).append(tuple(block))

    @staticmethod
    def _mutual(parts: list[tuple]) -> tuple[int, str | None, str | None]:
        return strongest(blocks.edges(parts))


def monitor(events: DataFrame, slide: Slide = Slide(), watermark_seconds: int = 120, detector: Detector = Detector(), rule: ConflictRule = ConflictRule()) -> DataFrame:
    """A stream of reports on pages.  ``kind`` is window, late or evicted.

    A window has all columns of page_activity, those of anomalies and those of edit
    wars: alerts are windows whose anomaly_type isn't none, or whose pair or flag
    says so (see ``anomalies`` and ``wars``).  A late row has the event's id and
    time; an evicted page the time of its last edit.  Needs the RocksDB state store.
    """
    if detector.ttl_seconds is not None:
        check_ttl(slide, watermark_seconds, detector.ttl_seconds)
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    id_type = events.schema["event_id"].dataType.simpleString()
    fields = f"""kind string, wiki string, page_title string, window_start timestamp, window_end timestamp, page_id long, edit_count long, unique_editors long, human_edits long, bot_edits long, revert_count long,
        net_byte_delta long, last_revision_id long, provenance_id string, edit_burst_count long, mutual_revert_count long, editor_a string, editor_b string, anomaly_type string, anomaly_score double,
        threshold_used double, history_size int, event_id {id_type}, event_time timestamp"""
    output = T.StructType.fromDDL(fields)
    # as a number, so that rows behind the watermark come through and are judged by their windows
    timed = events.withWatermark("event_time", f"{watermark_seconds} seconds").withColumn("us", F.unix_micros("event_time"))
    watch = BlockMonitor(slide, detector, id_type, output)
    rows = blocks.pack(timed.where(F.col("us").isNotNull()), watch.slide, watch.offset, id_type)
    found = rows.groupBy("wiki", "page_title").transformWithState(watch, output, "Append", "EventTime")
    burst = F.when(F.col("edit_burst_count") >= rule.burst_min, F.col("edit_burst_count")).otherwise(0)
    exact = F.col("mutual_revert_count") * rule.mutual_weight + burst * rule.burst_weight
    flag = (F.col("mutual_revert_count") >= rule.mutual_threshold) | ((F.col("mutual_revert_count") > 0) & (exact >= rule.score_threshold))
    return found.withColumns({"edit_velocity": F.round(F.col("edit_count") / (slide.size / 60), 4), "conflict_score": F.round(exact, 4), "flag": flag})


def activity(reports: DataFrame) -> DataFrame:
    """Windows with the columns of page_activity."""
    names = ["wiki", "page_title", "window_start", "window_end", "page_id", "edit_count", "unique_editors", "human_edits", "bot_edits", "revert_count", "net_byte_delta", "last_revision_id", "provenance_id", "edit_velocity"]
    return reports.where(F.col("kind") == WINDOW).select(*names)


def anomalies(reports: DataFrame) -> DataFrame:
    """Unusual windows."""
    flagged = reports.where((F.col("kind") == WINDOW) & (F.col("anomaly_type") != "none"))
    return flagged.select("wiki", "page_title", "window_start", "window_end", "edit_count", "anomaly_type", "anomaly_score", "threshold_used")


def wars(reports: DataFrame) -> DataFrame:
    """Windows with a mutual pair or a flag."""
    flagged = reports.where((F.col("kind") == WINDOW) & ((F.col("mutual_revert_count") > 0) | F.col("flag")))
    return flagged.select("wiki", "page_title", "window_start", "window_end", "page_id", F.col("revert_count").alias("total_reverts"), "edit_burst_count", "mutual_revert_count", "editor_a", "editor_b", "conflict_score", "flag")


def pages_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The pages that a monitor's checkpoint has state of, with the time of their last edit."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "history").load()
    return state.select("key.wiki", "key.page_title", F.timestamp_micros("value.last_edit").alias("last_edit"))


class LateRows(StatefulProcessor):
    """The newest time that each key's rows have had."""

    def __init__(self, delay_us: int, order: str, names: list[str]):
        self.delay, self.at, self.row = delay_us, names.index(order), Row(*names, "late")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "us long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest = self.newest.get()[0] if self.newest.exists() else None
        at = self.at
        for *values, us in sorted(map(tuple, rows), key=lambda r: r[at]):
            yield self.row(*values, newest is not None and us is not None and us < newest - self.delay)
            newest = us if newest is None else newest if us is None else max(newest, us)
        if newest is not None:
            self.newest.update((newest,))


def mark_late(events: DataFrame, delay_seconds: int, by: tuple[str, ...] = ("partition",), order: str = "offset") -> DataFrame:
    """A stream's rows with `late`: older than the newest event before them, in their partition, less the delay.

    The watermark is each partition's own and moves with every row, so that what is
    late doesn't hang on how rows fall into batches.  A batch of one partition is
    sorted in one task, so a batch's size bounds its memory.  Needs the RocksDB
    state store.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    output = T.StructType([*events.schema.fields, T.StructField("late", T.BooleanType())])
    timed = events.withColumn("__us", F.unix_micros("event_time"))
    return timed.groupBy(*by).transformWithState(LateRows(delay_seconds * 1_000_000, order, events.columns), output, "Append", "None")
