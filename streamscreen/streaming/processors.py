"""Keyed state for the streaming rules."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Executors get the processors with the query; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TIMES = T.StructType([T.StructField("ts", T.LongType())])
_AMOUNT = T.StructType([T.StructField("amount", T.DoubleType())])
_LAST = T.StructType([T.StructField("ts", T.LongType())])
_CITY = T.StructType([T.StructField("city", T.StringType())])
_SEEN = T.StructType([T.StructField("ts", T.LongType()), T.StructField("amount", T.DoubleType())])


def _time_mode(ttl_ms: int | None) -> str:
    return "none" if ttl_ms is None else "processingTime"


def _rows_of(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    frames = [b for b in batches if len(b)]
    rows = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]
    return rows.sort_values(order, kind="stable", ignore_index=True)


class TransactionHistory(StatefulProcessor):
    """Adds ``recent_count`` and ``previous_amount`` to each transaction of a customer.

    Rows of one micro-batch are taken in event-time order. State: event times still inside the
    window of the newest row, and the last amount; both expire ``ttl_ms`` after they are written.
    """

    def __init__(self, window_ms: int, ttl_ms: int | None, time: str, tie: tuple[str, ...]):
        self._window_ms, self._ttl_ms = window_ms, ttl_ms
        self._time, self._tie = time, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._recent = handle.getListState("recent", _TIMES, self._ttl_ms)
        self._amount = handle.getValueState("last_amount", _AMOUNT, self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows_of(rows, [self._time, *self._tie])
        times = pdf[self._time].to_numpy(dtype="int64")
        amounts = pdf["amount"].to_numpy(dtype="float64")
        held = np.sort(np.fromiter((r[0] for r in self._recent.get()), dtype="int64"))
        cutoff = times - self._window_ms
        inside = len(held) - np.searchsorted(held, cutoff, side="left")
        own = np.arange(1, len(times) + 1) - np.searchsorted(times, cutoff, side="left")
        before = np.empty(len(amounts))
        state = self._amount.get()
        before[0] = np.nan if state is None else state[0]
        before[1:] = amounts[:-1]

        kept = np.concatenate([held, times])
        kept = kept[kept >= cutoff[-1]]
        self._recent.put([(int(t),) for t in kept])
        self._amount.update((float(amounts[-1]),))
        yield pdf.assign(recent_count=inside + own,
                         previous_amount=pd.Series(before).astype("Float64").where(~np.isnan(before), None))

    def close(self) -> None:
        pass


def with_streaming_history(transactions: DataFrame, window_ms: int, ttl_ms: int | None = 3_600_000, *,
                           key: str = "customer_id", time: str = "event_time",
                           tie: tuple[str, ...] = ("transaction_id",)) -> DataFrame:
    """Streaming form of :func:`streamscreen.operators.rules.with_history`.

    Late rows are kept. State that may expire needs processing time, in which Spark keeps starting
    micro-batches; pass ``ttl_ms=None`` for a query that is to end when its input is used up.
    """
    columns = [c for c in ("transaction_id", "customer_id", "amount", "city", "event_time", "hour")
               if c in transactions.columns]
    source = transactions.select(*columns)
    schema = T.StructType([*source.schema.fields,
                           T.StructField("recent_count", T.LongType()),
                           T.StructField("previous_amount", T.DoubleType())])
    return source.groupBy(key).transformWithStateInPandas(
        TransactionHistory(window_ms, ttl_ms, time, tie), schema, "append", _time_mode(ttl_ms))


class CoolOff(StatefulProcessor):
    """Keeps an alert only if the key's last kept alert is at least ``quiet_ms`` older."""

    def __init__(self, quiet_ms: int, time: str, tie: tuple[str, ...], ttl_ms: int | None):
        self._quiet_ms, self._time, self._tie, self._ttl_ms = quiet_ms, time, tie, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last_kept", _LAST, self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows_of(rows, [self._time, *self._tie])
        times = pdf[self._time].to_numpy(dtype="int64")
        state = self._last.get()
        at = 0 if state is None else int(np.searchsorted(times, state[0] + self._quiet_ms, side="left"))
        keep = []
        while at < len(times):
            keep.append(at)
            at = int(np.searchsorted(times, times[at] + self._quiet_ms, side="left"))
        if keep:
            self._last.update((int(times[keep[-1]]),))
            yield pdf.iloc[keep]

    def close(self) -> None:
        pass


def cool_off_stream(alerts: DataFrame, *, key: str = "customer_id", time: str = "event_time",
                    tie: tuple[str, ...] = ("transaction_id", "rule_id"), quiet_ms: int = 300_000,
                    ttl_ms: int | None = None) -> DataFrame:
    """Streaming form of :func:`streamscreen.operators.rules.cool_off`."""
    return alerts.groupBy(key).transformWithStateInPandas(
        CoolOff(quiet_ms, time, tie, ttl_ms), alerts.schema, "append", _time_mode(ttl_ms))


class BucketTotals(StatefulProcessor):
    """Running totals per key: rows per time bucket (map state) and one amount sum (value state)."""

    def __init__(self, bucket_ms: int, time: str, ttl_ms: int | None):
        self._bucket_ms, self._time, self._ttl_ms = bucket_ms, time, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        count = T.StructType([T.StructField("n", T.LongType())])
        bucket = T.StructType([T.StructField("bucket", T.LongType())])
        self._counts = handle.getMapState("counts", bucket, count, self._ttl_ms)
        self._sum = handle.getValueState("sum", _AMOUNT, self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        added, total = pd.Series(dtype="int64"), 0.0
        for pdf in rows:
            buckets = pdf[self._time] // self._bucket_ms * self._bucket_ms
            added = added.add(buckets.value_counts(), fill_value=0)
            total += float(pdf["amount"].sum())
        state = self._sum.get()
        total += 0.0 if state is None else state[0]
        self._sum.update((total,))
        out = []
        for bucket, n in added.items():
            slot = (int(bucket),)
            held = self._counts.getValue(slot) if self._counts.containsKey(slot) else (0,)
            self._counts.updateValue(slot, (held[0] + int(n),))
            out.append((key[0], int(bucket), held[0] + int(n), total))
        yield pd.DataFrame(out, columns=["key", "bucket_ms", "bucket_count", "running_amount"])

    def close(self) -> None:
        pass


def bucket_totals(transactions: DataFrame, *, key: str = "customer_id", time: str = "event_time",
                  bucket_ms: int = 60_000, ttl_ms: int | None = 3_600_000) -> DataFrame:
    """Updated counts per time bucket and the running amount of each key seen in a micro-batch."""
    return transactions.select(key, time, "amount").groupBy(key).transformWithStateInPandas(
        BucketTotals(bucket_ms, time, ttl_ms),
        "key string, bucket_ms long, bucket_count long, running_amount double",
        "update", _time_mode(ttl_ms))


class ManyCities(StatefulProcessor):
    """Gives out transactions at which a customer has used more than ``limit`` cities within the window.

    State: for each city when it was used last (map state). Cities that have left the window are dropped with the next
    row of the customer, or by an event-time timer if none comes.
    """

    def __init__(self, window_ms: int, limit: int, time: str, tie: tuple[str, ...]):
        self._window_ms, self._limit, self._time, self._tie = window_ms, limit, time, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._cities = handle.getMapState("cities", _CITY, _LAST)

    def _held(self) -> dict[str, int]:
        return {city[0]: last[0] for city, last in self._cities.iterator()}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows_of(rows, [self._time, *self._tie])
        before = self._held()
        cities, counts = dict(before), np.zeros(len(pdf), dtype="int64")
        # Cities in order of their last use, so those that leave the window stand first.
        cities = dict(sorted(cities.items(), key=lambda c: c[1]))
        for at, (t, city) in enumerate(zip(pdf[self._time].tolist(), pdf["city"].tolist(), strict=True)):
            if city is not None and city == city:
                last = max(t, cities.pop(city, t))
                cities[city] = last
                if last > t:  # a late row: put the cities in order again
                    cities = dict(sorted(cities.items(), key=lambda c: c[1]))
            newest = max(cities.values(), default=t)
            while cities and next(iter(cities.values())) < newest - self._window_ms:
                del cities[next(iter(cities))]
            counts[at] = sum(t - self._window_ms <= last for last in cities.values())
        for city in before.keys() - cities.keys():
            self._cities.removeKey((city,))
        for city, last in cities.items():
            if before.get(city) != last:
                self._cities.updateValue((city,), (last,))
        for old in list(self._handle.listTimers()):
            self._handle.deleteTimer(old)
        if cities:
            self._handle.registerTimer(next(iter(cities.values())) + self._window_ms + 1)
        over = counts > self._limit
        if over.any():
            yield pdf[over].assign(city_count=counts[over])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        left = []
        for city, last in self._held().items():
            if last + self._window_ms < now:
                self._cities.removeKey((city,))
            else:
                left.append(last)
        if left:
            self._handle.registerTimer(min(left) + self._window_ms + 1)
        return iter(())

    def close(self) -> None:
        pass


def many_cities_stream(transactions: DataFrame, *, window_ms: int = 30 * 60_000, limit: int = 3, key: str = "customer_id",
                       time: str = "event_time", tie: tuple[str, ...] = ("transaction_id",), at: str = "event_ts",
                       watermark: str = "5 seconds") -> DataFrame:
    """Streaming form of :func:`streamscreen.operators.rules.many_cities`. Rows behind the watermark of ``at`` are late and left out."""
    schema = T.StructType([*transactions.drop(at).schema.fields, T.StructField("city_count", T.LongType())])
    stream = transactions.withWatermark(at, watermark)
    made = stream.groupBy(key).transformWithStateInPandas(
        ManyCities(window_ms, limit, time, tie), T.StructType([*stream.schema.fields, schema["city_count"]]), "append", "eventTime")
    return made.select(*schema.fieldNames())


class FadingHistory(StatefulProcessor):
    """Adds ``previous_amount`` and ``rows_so_far`` of a customer, both forgotten after ``quiet_ms`` of event time without a row.

    A timer clears the state of a customer who stays away; a row that comes before the timer has run, but after that long a pause, finds
    nothing either, so the result does not depend on where micro-batches end.
    """

    def __init__(self, quiet_ms: int, time: str, tie: tuple[str, ...]):
        self._quiet_ms, self._time, self._tie = quiet_ms, time, tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", _SEEN)
        self._rows = handle.getValueState("rows", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows_of(rows, [self._time, *self._tie])
        times, amounts = pdf[self._time].to_numpy(dtype="int64"), pdf["amount"].to_numpy(dtype="float64")
        last, held = self._last.get(), self._rows.get()
        before_time = np.concatenate([[times[0] if last is None else last[0]], times[:-1]])
        before = np.concatenate([[np.nan if last is None or last[1] is None else last[1]], amounts[:-1]])
        starts = times - before_time > self._quiet_ms
        starts[0] |= last is None
        before[starts] = np.nan
        place = np.arange(len(times))
        since = np.maximum.accumulate(np.where(starts, place, -1))
        count = np.where(since >= 0, place - since + 1, place + 1 + (0 if held is None else held[0]))
        for old in list(self._handle.listTimers()):
            self._handle.deleteTimer(old)
        self._last.update((int(times[-1]), None if np.isnan(amounts[-1]) else float(amounts[-1])))
        self._rows.update((int(count[-1]),))
        self._handle.registerTimer(int(times[-1]) + self._quiet_ms + 1)
        yield pdf.assign(rows_so_far=count, previous_amount=pd.Series(before).astype("Float64").where(~np.isnan(before), None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._last.clear()
        self._rows.clear()
        return iter(())

    def close(self) -> None:
        pass


def with_fading_history(transactions: DataFrame, quiet_ms: int, *, key: str = "customer_id", time: str = "event_time",
                        tie: tuple[str, ...] = ("transaction_id",), at: str = "event_ts", watermark: str = "5 seconds") -> DataFrame:
    """Previous amount and rows so far of each customer, with state that expires in event time: a replay ends by itself and repeats its result."""
    stream = transactions.withWatermark(at, watermark)
    schema = T.StructType([*stream.schema.fields, T.StructField("rows_so_far", T.LongType()),
                           T.StructField("previous_amount", T.DoubleType())])
    made = stream.groupBy(key).transformWithStateInPandas(FadingHistory(quiet_ms, time, tie), schema, "append", "eventTime")
    return made.drop(at)
