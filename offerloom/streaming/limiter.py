"""A rate limiter whose windows open at a key's first event, in batch and as a stream.

A window ends at the first event later than ``seconds`` after its first one; an
event exactly then is still inside. Every event counts, rejected ones too.

Which events open windows looks like a walk from event to event, but a range of a
key's events is a map from the window that is open before it to the one open after it,
and such maps compose. So a key's events are cut into ranges of time, all ranges make
their maps at once, these are composed in order, and then all ranges are numbered at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from offerloom.worktables import materialize

#: Microseconds of an event without a time.
NO_TIME = np.iinfo(np.int64).min


def _micros(times: pd.Series) -> np.ndarray:
    return times.to_numpy().astype("datetime64[us]").astype(np.int64)


def _numbered(times: np.ndarray, start: int | None, n: int, width: int) -> tuple[np.ndarray, int, int]:
    """(number of each event in its window, the last window's start, its count); a step is a window, not an event."""
    numbers, at = np.empty(len(times), np.int64), 0
    while at < len(times):
        if start is None or start != NO_TIME and times[at] > start + width:
            start, n = int(times[at]), 0
        stop = len(times) if start == NO_TIME else at + int(np.searchsorted(times[at:], start + width, side="right"))
        numbers[at:stop] = np.arange(n + 1, n + 1 + stop - at)
        n, at = n + stop - at, stop
    return numbers, start, n


def _map_of(times: np.ndarray, width: int) -> tuple[list[int], list[int], list[int]]:
    """The map of a range: (upper ends, window starts, counts).

    A window that was open before and ends below the nth upper end, but not below the
    one before, leaves the nth start open with its count; one that ends at no upper
    end or above stays open. As it began no later than the range, only events
    within a window's width of the first one are ends, and neighbours that lead to the same start are one.
    """
    m = len(times)
    if not m or times[0] == NO_TIME:  # events without a time stay in the window of those before
        return [], [], []
    after = np.searchsorted(times, times + width, side="right").tolist()
    last = list(range(m))
    for i in range(m - 1, -1, -1):
        if after[i] < m:
            last[i] = last[after[i]]
    reach = min(m, after[0] + 1)
    opens = np.array(last[:reach])
    ends = np.append(np.flatnonzero(opens[1:] != opens[:-1]), reach - 1)
    return times[ends].tolist(), times[opens[ends]].tolist(), (m - opens[ends]).tolist()


def _through(start: int | None, n: int, m: int, maps: tuple) -> tuple[int, int]:
    """The window that is open after a range of ``m`` events, by its map, and its count; without one before, the range's first event opens one."""
    upper, starts, counts, first, width = maps
    if start is None:
        return _through(first - width - 1, 0, m, maps) if len(upper) else (NO_TIME, m)
    if start == NO_TIME:
        return start, n + m
    k = int(np.searchsorted(upper, start + width, side="right"))
    return (int(starts[k]), int(counts[k])) if k < len(upper) else (start, n + m)


def counted(events: DataFrame, key: str, ts: str, seconds: int, limit: int, order: str | None = None) -> DataFrame:
    """Adds ``count`` (the event's number in its window) and ``limited``.

    Events are dealt by ranges of key and time, so a key with all events lies in all
    tasks. A task numbers the keys that begin in it, in one pass over sorted batches.
    The key that it begins with may go on from the range before: of its events it makes the
    map. The maps of a key are composed in order, in one task a key that reads a map
    after the other: no more than the times within one window's width a range. Then the events
    left are numbered, again by range. A task holds the times of its range. Columns
    that begin with ``_limiter_`` are the function's own.

    Events without a time come first and are one window with all others of their
    key; a null key is a key.
    """
    tie, width, names = order or ts, seconds * 1_000_000, list(events.columns)
    fields = [T.StructField(f.name, f.dataType) for f in events.schema.fields]
    own = "_limiter_part int, _limiter_open boolean, count long, limited boolean, _limiter_kind int, _limiter_m long, _limiter_start long, _limiter_n long, _limiter_first long, _limiter_map binary"
    schema = T.StructType(fields + list(T._parse_datatype_string(own).fields))

    def ranges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first_key = last_key = part = None
        begun, held, start, n = False, [], None, 0

        def whole(frame: pd.DataFrame) -> pd.DataFrame:
            return frame.assign(**{c: pd.Series([None] * len(frame), dtype=object, index=frame.index) for c in schema.names if c not in frame.columns})[schema.names]

        def summary(k: pd.Series, **values) -> pd.DataFrame:
            own = {f"_limiter_{c}": pd.Series([v], dtype=object) for c, v in ({"part": part} | values).items()}
            return whole(pd.DataFrame({key: k.array}).assign(**own))

        for frame in frames:
            if not len(frame):
                continue
            if first_key is None:
                first_key, part = frame[key].iloc[:1], int(frame["_limiter_part"].iloc[0])
            keys, times = frame[key], _micros(frame[ts])
            before = keys.shift()
            cuts = (np.flatnonzero((keys.ne(before) & ~(keys.isna() & before.isna())).to_numpy()[1:]) + 1).tolist()
            numbers, is_open = np.zeros(len(frame), np.int64), np.zeros(len(frame), bool)
            for at, end in zip([0, *cuts], [*cuts, len(frame)]):
                k = keys.iat[at]
                same = last_key is not None and (k == last_key.iat[0] or pd.isna(k) and pd.isna(last_key.iat[0]))
                if last_key is not None and not same:
                    begun, start, n = True, None, 0
                last_key = keys.iloc[at : at + 1]
                if begun:
                    numbers[at:end], start, n = _numbered(times[at:end], start, n, width)
                else:
                    held.append(times[at:end])
                    is_open[at:end] = True
            yield whole(frame.assign(count=numbers, limited=numbers > limit, _limiter_open=is_open))
        if first_key is not None:
            times = np.concatenate(held)
            yield summary(first_key, kind=1, m=len(times), first=int(times[0]), map=np.array(_map_of(times, width), np.int64).tobytes())
            if begun:
                yield summary(last_key, kind=0, start=start, n=n)

    def composed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, start, n = None, None, 0
        for frame in frames:
            out = []
            for k, part, kind, m, s, count, first, packed in frame.itertuples(index=False):
                if last is None or not (k == last[0] or pd.isna(k) and pd.isna(last[0])):
                    last, start, n = (k,), None, 0
                if kind == 0:
                    start, n = int(s), int(count)
                    continue
                out.append((int(part), start is not None, start or 0, n))
                start, n = _through(start, n, int(m), (*np.frombuffer(packed, np.int64).reshape(3, -1), int(first), width))
            yield pd.DataFrame(out, columns=["_limiter_part", "_limiter_known", "_limiter_start", "_limiter_n"])

    def rest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, start, n = None, None, 0
        for frame in frames:
            parts, times = frame["_limiter_part"].to_numpy(), _micros(frame[ts])
            numbers = np.zeros(len(frame), np.int64)
            cuts = (np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist()
            for at, end in zip([0, *cuts], [*cuts, len(frame)]) if len(frame) else ():
                if parts[at] != part:
                    part, known = parts[at], frame["_limiter_known"].iat[at]
                    start, n = (int(frame["_limiter_start"].iat[at]), int(frame["_limiter_n"].iat[at])) if known else (None, 0)
                numbers[at:end], start, n = _numbered(times[at:end], start, n, width)
            yield frame[names].assign(count=numbers, limited=numbers > limit)

    dealt = events.repartitionByRange(key, ts, tie).sortWithinPartitions(key, ts, tie).withColumn("_limiter_part", F.spark_partition_id())
    found = materialize(dealt.mapInPandas(ranges, schema), "limiter-ranges")
    maps = found.filter("_limiter_kind IS NOT NULL").select(key, "_limiter_part", "_limiter_kind", *(F.coalesce(f"_limiter_{c}", F.lit(0)).alias(f"_limiter_{c}") for c in ("m", "start", "n", "first")), "_limiter_map")
    before = maps.repartition(key).sortWithinPartitions(key, "_limiter_part", F.desc("_limiter_kind")).mapInPandas(composed, "_limiter_part int, _limiter_known boolean, _limiter_start long, _limiter_n long")
    before = materialize(before, "limiter-before")  # a row a range at most, so it can go to every task
    left = found.filter("_limiter_kind IS NULL AND _limiter_open").select(*names, "_limiter_part").join(F.broadcast(before), "_limiter_part")
    out = T.StructType(fields).add("count", "long").add("limited", "boolean")
    numbered = left.repartition("_limiter_part").sortWithinPartitions("_limiter_part", key, ts, tie).mapInPandas(rest, out)
    return found.filter("_limiter_kind IS NULL AND NOT _limiter_open").select(*names, "count", "limited").unionByName(numbered)


class _Windows(StatefulProcessor):
    """A key's events wait until the watermark has passed them, and are numbered in order of time then."""

    def __init__(self, key: str, ts: str, seconds: int, limit: int):
        self.key, self.ts, self.width, self.limit = key, ts, seconds * 1000, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long")
        self.window = handle.getValueState("window", "start long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            at = _micros(frame[self.ts])
            if len(at):
                self.waiting.appendList([(int(x),) for x in at])
                self.handle.registerTimer(int(at.min()) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        waiting = np.sort(np.array([x[0] for x in self.waiting.get()] if self.waiting.exists() else [], np.int64))
        due = waiting[waiting < mark * 1000]
        start, n = self.window.get() if self.window.exists() else (None, 0)
        if len(due):
            rest = waiting[len(due) :]
            if len(rest):
                self.waiting.put([(int(x),) for x in rest])
                self.handle.registerTimer(int(rest[0]) // 1000 + 1)
            else:
                self.waiting.clear()
            numbers, start, n = _numbered(due, start, n, self.width * 1000)
            self.window.update((start, n))
            self.handle.registerTimer(start // 1000 + self.width + 2)
            yield pd.DataFrame({self.key: key[0], self.ts: due.astype("datetime64[us]"), "count": numbers, "limited": numbers > self.limit})
        if start is not None and mark > start // 1000 + self.width + 1:
            self.window.clear()  # whatever comes is later than its end, and opens a window anyway

    def close(self) -> None:
        pass


def stream(events: DataFrame, key: str, ts: str, seconds: int, limit: int, delay: str = "1 minute") -> DataFrame:
    """(key, ts, count, limited) of a stream: what ``counted`` gives, however events are spread over batches.

    An event is numbered when the watermark, ``delay`` behind the latest event, has
    passed it; one that is later than that is dropped, as one without a time is. A key's state is the events that
    wait, within ``delay``, and its window's start and count, which go when the window is over.
    Needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    kind = events.schema[key].dataType.simpleString()
    timed = events.select(key, ts).filter(F.col(ts).isNotNull()).withWatermark(ts, delay)
    return timed.groupBy(key).transformWithStateInPandas(_Windows(key, ts, seconds, limit), T._parse_datatype_string(f"{key} {kind}, {ts} timestamp, count long, limited boolean"), "Append", "EventTime")


def valid_email(email: Column) -> Column:
    return F.coalesce(email.rlike("^[^\\s@]+@[^\\s@]+\\.[^\\s@]{2,}$"), F.lit(False))


def response(method: Column, limited: Column, product: Column, email: Column) -> Column:
    """The status of a request: 405, 429, 400 or 200, checked in that order."""
    missing = (F.length(F.coalesce(product, F.lit(""))) == 0) | (F.length(F.coalesce(email, F.lit(""))) == 0)
    return F.when(F.coalesce(method, F.lit("")) != "POST", 405).when(limited, 429).when(missing | ~valid_email(email) | ~product.rlike("^[0-9]+$"), 400).otherwise(200)


def first_address(forwarded: Column) -> Column:
    """The first address of a forwarding header, else unknown."""
    first = F.trim(F.substring_index(F.coalesce(forwarded, F.lit("")), ",", 1))
    return F.when(first == "", "unknown").otherwise(first)


def backed_off(events: DataFrame, key: str, order: str, failed: str, most: int = 15) -> DataFrame:
    """Adds ``run`` (failures in a row so far) and ``backs_off``: each time a run passes ``most`` it starts anew."""
    from pyspark.sql import Window

    by_key = Window.partitionBy(key).orderBy(order)
    marked = events.withColumn("_island", F.sum(F.when(F.col(failed), 0).otherwise(1)).over(by_key))
    run = F.sum(F.when(F.col(failed), 1).otherwise(0)).over(Window.partitionBy(key, "_island").orderBy(order))
    again = F.when(F.col(failed), (run - 1) % (most + 1) + 1).otherwise(0)
    return marked.withColumn("run", again).withColumn("backs_off", F.col("run") > most).drop("_island")
