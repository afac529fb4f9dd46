"""Keyed state in streams: card history features (M3, M4), held alerts (M9), heartbeats (M8).

Every operator is a ``StatefulProcessor`` over RocksDB state. Rows wait in a reorder buffer (list
state) until the watermark has passed them and are then taken in time order, so the result does not
depend on how rows fall into files and batches as long as they come within the watermark's delay.
Timers, not further rows, release them; a key whose work is done leaves no state behind.

The watermark moves with every row, also with rows without an id (``tick``): a source that falls
silent is closed by one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from chronotab.functions.scalar import haversine_km, nan_to_null
from chronotab.functions.timecols import MICROS_PER_DAY, MICROS_PER_HOUR, micros
from chronotab.operators.windows import AMOUNT_SCALE, COORD_SCALE, HISTORY_DAYS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ABSENT = np.iinfo(np.int64).min  # stands in the state for a null number


def with_state_store(df: DataFrame) -> DataFrame:
    """``df``; streams of its session keep their state in RocksDB from now on."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return df


def watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """``df`` with ``t`` (microseconds) under a watermark on ``ts``. The watermark's own column does
    not go on, so that rows behind it reach the operator, which decides what becomes of them."""
    # ticks are left out by the operators: a filter here would be moved below the watermark
    marked = with_state_store(df).withColumn("_wm", F.col(ts).cast("timestamp")).withWatermark("_wm", delay)
    return marked.withColumn("t", micros(ts)).drop("_wm")


def key_text(c) -> Column:
    """A key that is never null: ``+`` and the value as text, empty for null. (Frames turn whole
    numbers beside nulls into floats, and do not take names that start with an underscore.)"""
    return F.coalesce(F.concat(F.lit("+"), F.col(c).cast("string")), F.lit(""))


SLOTS = 64  # keys of one slot share state; fixed for the life of a checkpoint


def slot(c, slots: int) -> Column:
    """The slot of a key: few state keys with many rows each, so that a batch costs what its rows cost
    and not a round trip for every key."""
    return F.pmod(F.xxhash64(c), F.lit(slots)).cast("string")


PACKED = "rows binary"


def pack(rows: pd.DataFrame) -> tuple[bytes]:
    """Rows as one state value."""
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def unpack(values, columns: list[str]) -> pd.DataFrame:
    parts = [pa.ipc.open_stream(v[0]).read_pandas() for v in values]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=columns)


# ------------------------------------------------------------------ M3, M4: card features

HISTORY = ["card", "t", "c", "cat", "la", "lo"]
WAITING = ["card", "t", "id", "cat", "amt", "lat", "long"]

FEATURES = [
    ("CC_TXN_COUNT_1H", LongType()), ("CC_TXN_COUNT_24H", LongType()), ("CC_AMT_SUM_24H", DoubleType()),
    ("CC_AMT_AVG_30D", DoubleType()), ("CC_AMT_STD_30D", DoubleType()), ("AMT_DEVIATION_FROM_CC_AVG", DoubleType()),
    ("AMT_ZSCORE_30D", DoubleType()), ("CC_CATEGORY_TXN_COUNT_30D", LongType()),
    ("AMT_DEVIATION_FROM_CC_CATEGORY_AVG", DoubleType()), ("CC_SECONDS_SINCE_LAST_TXN", DoubleType()),
    ("_usual_lat", DoubleType()), ("_usual_long", DoubleType()),
]


# Late rows carry nulls in place of features.
CARD_OUTPUT = StructType([
    StructField("trans_num", StringType()), StructField("card", StringType()), StructField("trans_ts", TimestampNTZType()),
    StructField("late", BooleanType()), *[StructField(n, t) for n, t in FEATURES],
    StructField("_lat", DoubleType()), StructField("_long", DoubleType())])


def _whole(column: pd.Series, scale: int) -> np.ndarray:
    """Fixed-point integers; ABSENT for nulls."""
    values = column.to_numpy(dtype=float)
    return np.where(np.isnan(values), ABSENT, np.rint(np.nan_to_num(values) * 10**scale)).astype(np.int64)


def _running(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(x.astype(object))])  # exact integers


def _between(total: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return total[high] - total[low]


def card_features(past: pd.DataFrame, now: pd.DataFrame, history_us: int) -> pd.DataFrame:
    """The features of the rows ``now`` (card, t, cat, amt) from their cards' events ``past`` (as HISTORY),
    strictly before and at most ``history_us`` old, with the batch operator's arithmetic."""
    codes = pd.factorize(pd.concat([past["card"], now["card"]]))[0]
    # a null category is a value of its own, as in the batch windows
    kinds = pd.factorize(pd.concat([past["cat"], now["cat"]]).fillna("\0"))[0]
    order = np.lexsort((past["t"].to_numpy(dtype=np.int64), codes[:len(past)]))
    past, card, kind = past.iloc[order], codes[:len(past)][order], kinds[:len(past)][order]
    own_card, own_kind = codes[len(past):], kinds[len(past):]
    at, c, la, lo = (past[x].to_numpy(dtype=np.int64) for x in ("t", "c", "la", "lo"))
    has, known = c != ABSENT, la != ABSENT
    cents = np.where(has, c, 0).astype(object)
    n_all, n_places = np.concatenate([[0], np.cumsum(has)]), np.concatenate([[0], np.cumsum(known)])
    s_all, q_all = _running(cents), _running(cents * cents)
    la_all, lo_all = (_running(np.where(known, x, 0)) for x in (la, lo))

    t, amt = now["t"].to_numpy(dtype=np.int64), now["amt"].to_numpy(dtype=float)
    first = min(t.min(), at.min()) if len(at) else t.min()
    span = max(t.max(), at.max() if len(at) else t.max()) - first + 1

    def place(group, times):  # one number for a group and a time in it, none below the group's own
        return group.astype(np.int64) * span + np.maximum(times - first, 0)

    places_at = place(card, at)
    high = np.searchsorted(places_at, place(own_card, t), "left")
    from_30d, from_24h, from_1h = (np.searchsorted(places_at, place(own_card, t - w), "left")
                                   for w in (history_us, 24 * MICROS_PER_HOUR, MICROS_PER_HOUR))
    n, s, q = (_between(x, high, from_30d) for x in (n_all, s_all, q_all))
    places = _between(n_places, high, from_30d)
    unit, degree = 10.0**AMOUNT_SCALE, 10.0**COORD_SCALE

    def mean(total, count, scale):
        return np.array([float(x) / k / scale if k else np.nan for x, k in zip(total, count)])

    average = mean(s, n, unit)
    std = np.array([np.sqrt(float(k * b - a * a) / float(k * (k - 1)) / unit**2) if k > 1 else np.nan
                    for k, a, b in zip(n.astype(object), s, q)])
    deviation = amt - average
    both = pd.factorize(np.concatenate([card, own_card]).astype(np.int64) * (int(kinds.max()) + 1) + np.concatenate([kind, own_kind]))[0]
    sort = np.lexsort((at[has], both[:len(past)][has]))
    total, places_cat, own = _running(cents[has][sort]), place(both[:len(past)][has][sort], at[has][sort]), both[len(past):]
    up, low = (np.searchsorted(places_cat, place(own, x), "left") for x in (t, t - history_us))
    n_cat, average_cat = up - low, mean(_between(total, up, low), up - low, unit)
    seen = high > from_30d
    last = at[np.maximum(high - 1, 0)] if len(at) else np.zeros(len(t), dtype=np.int64)
    return pd.DataFrame({
        "CC_TXN_COUNT_1H": _between(n_all, high, from_1h), "CC_TXN_COUNT_24H": _between(n_all, high, from_24h),
        "CC_AMT_SUM_24H": _between(s_all, high, from_24h).astype(float) / unit, "CC_AMT_AVG_30D": average, "CC_AMT_STD_30D": std,
        "AMT_DEVIATION_FROM_CC_AVG": deviation, "AMT_ZSCORE_30D": np.where(std > 0, deviation / np.where(std > 0, std, 1.0), np.nan),
        "CC_CATEGORY_TXN_COUNT_30D": n_cat, "AMT_DEVIATION_FROM_CC_CATEGORY_AVG": amt - average_cat,
        "CC_SECONDS_SINCE_LAST_TXN": np.where(seen, (t - last) / 1e6, np.nan),
        "_usual_lat": mean(_between(la_all, high, from_30d), places, degree),
        "_usual_long": mean(_between(lo_all, high, from_30d), places, degree)}, index=now.index)


def _nulls(rows: pd.DataFrame) -> pd.DataFrame:
    """Features of late rows: none."""
    return pd.DataFrame({n: pd.array([None] * len(rows), dtype="Int64" if isinstance(t, LongType) else "Float64")
                         for n, t in FEATURES}, index=rows.index)


class CardFeatures(StatefulProcessor):
    """One (slot of cards, time bucket): events wait in ``pending`` until the watermark has passed them,
    all events that may matter to the bucket are in ``history``, both packed batch by batch. When the
    watermark passes the bucket's end nothing can come any more, and the key's state is dropped."""

    def __init__(self, history_us: int, bucket_us: int):
        self.history_us, self.bucket_us = history_us, bucket_us

    def init(self, handle) -> None:
        self.handle = handle
        self.history = handle.getListState("history", PACKED)
        self.pending = handle.getListState("pending", PACKED)

    def _out(self, rows: pd.DataFrame, features: pd.DataFrame, late: bool) -> pd.DataFrame:
        head = pd.DataFrame({"trans_num": rows["id"], "card": rows["card"], "trans_ts": pd.to_datetime(rows["t"], unit="us"), "late": late})
        return pd.concat([head, features, rows[["lat", "long"]].rename(columns={"lat": "_lat", "long": "_long"})], axis=1)

    def _end(self, key) -> int:
        """The bucket's end in milliseconds."""
        return (int(key[1][1:]) + 1) * self.bucket_us // 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        new = new[new["id"].notna()]
        own = new[new["home"]]
        if key[1] == "":  # an event without a time has no history and is nobody's
            if len(own):
                out = self._out(own, card_features(pd.DataFrame(columns=HISTORY), own.assign(t=0), self.history_us), False)
                yield out.assign(trans_ts=pd.NaT)
            return
        gone = timerValues.getCurrentWatermarkInMs()
        late = own[own["t"] // 1000 < gone]
        if len(late):
            yield self._out(late, _nulls(late), True)
        new, own = (x[x["t"] // 1000 >= gone] for x in (new, own))
        if not len(new):
            return
        self.history.appendValue(pack(pd.DataFrame({
            "card": new["card"], "t": new["t"].astype(np.int64), "c": _whole(new["amt"], AMOUNT_SCALE), "cat": new["cat"].astype("string"),
            "la": _whole(new["lat"], COORD_SCALE), "lo": _whole(new["long"], COORD_SCALE)})))
        timers = set(self.handle.listTimers())
        if self._end(key) not in timers:
            self.handle.registerTimer(self._end(key))
        if len(own):
            self.pending.appendValue(pack(own[WAITING].astype({"t": np.int64, "cat": "string"})))
            first = int(own["t"].min()) // 1000
            if not any(x <= first for x in timers):
                self.handle.registerTimer(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gone = timerValues.getCurrentWatermarkInMs()
        waiting = unpack(self.pending.get(), WAITING)
        ready = waiting["t"] // 1000 < gone if len(waiting) else pd.Series(dtype=bool)
        if ready.any():
            past = unpack(self.history.get(), HISTORY)
            now = waiting[ready].sort_values("t", kind="stable").reset_index(drop=True)
            yield self._out(now, card_features(past, now, self.history_us), False)
            waiting = waiting[~ready]
        if self._end(key) < gone:
            for x in list(self.handle.listTimers()):
                self.handle.deleteTimer(x)
            self.history.clear()
            self.pending.clear()
        elif len(waiting):
            if ready.any():
                self.pending.put([pack(waiting)])
            first = int(waiting["t"].min()) // 1000
            if first not in set(self.handle.listTimers()):
                self.handle.registerTimer(first)
        else:
            self.pending.clear()


def stream_event_features(tx: DataFrame, card: str = "card", delay: str = "2 days", history_days: int = HISTORY_DAYS,
                          bucket_days: int = 30, slots: int = SLOTS) -> DataFrame:
    """M3 + M4: the card-history features of every event, released in time order once the watermark
    (``delay`` behind the newest event) has passed it; equal to the batch ``event_features`` whatever
    the order in which events come within ``delay``. An event that comes behind the watermark is passed
    on at once, flagged ``late``, without features, and is nobody's history.

    State is keyed by (slot of cards, time bucket) and every event is copied, as context, into the later buckets
    that look back on it, so a card's history spreads over tasks and is dropped bucket by bucket. Rows
    without ``trans_num`` are ticks: they move the watermark and give no row."""
    hist_us, bucket_us = history_days * MICROS_PER_DAY, bucket_days * MICROS_PER_DAY
    cols = watermarked(tx, "trans_ts", delay)
    own = F.floor(F.col("t") / F.lit(bucket_us)).cast("bigint")
    last = F.floor((F.col("t") + F.lit(hist_us)) / F.lit(bucket_us)).cast("bigint")
    spread = cols.select("*", F.explode_outer(F.sequence(own, last)).alias("_bk")).select(
        slot(key_text(card), slots).alias("slot"), key_text(card).alias("card"), key_text("_bk").alias("bucket"), (F.col("_bk").isNull() | (F.col("_bk") == own)).alias("home"), "t",
        F.col("trans_num").cast("string").alias("id"), F.col("category").alias("cat"), F.col("amt").cast("double").alias("amt"),
        F.col("merch_lat").cast("double").alias("lat"), F.col("merch_long").cast("double").alias("long"))
    out = spread.groupBy("slot", "bucket").transformWithStateInPandas(CardFeatures(hist_us, bucket_us), CARD_OUTPUT, "Append", "EventTime")
    out = out.withColumns({"trans_num": F.col("trans_num").cast(tx.schema["trans_num"].dataType),
                           "card": F.when(F.col("card") != "", F.substring("card", 2, 1 << 30)).cast(tx.schema[card].dataType)})
    doubles = [n for n, t in FEATURES if isinstance(t, DoubleType)]
    out = out.withColumns({c: nan_to_null(c) for c in [*doubles, "_lat", "_long"]})
    apart = haversine_km("_usual_lat", "_usual_long", "_lat", "_long")
    return out.withColumn("DISTANCE_FROM_USUAL_MERCHANT_KM", apart).drop("_usual_lat", "_usual_long", "_lat", "_long")


# ------------------------------------------------------------------ M9: held alerts

ALERT_OUTPUT = StructType([StructField("series", StringType()), StructField("run_start", TimestampNTZType()),
                           StructField("fire_at", TimestampNTZType())])


class HeldAlert(StatefulProcessor):
    """One slot of series: samples wait in ``pending``, packed batch by batch; ``run`` holds the runs that
    are open, their start and newest sample and whether they have fired. Without an open run and waiting
    samples there is no state."""

    def __init__(self, hold_us: int, on_sample: bool):
        self.hold, self.on_sample = hold_us, on_sample

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", PACKED)
        self.run = handle.getValueState("run", PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        gone = timerValues.getCurrentWatermarkInMs()
        new = pd.concat(list(rows), ignore_index=True)
        new = new[(new["t"] // 1000 >= gone) & (new["series"] != "")]  # without a time: left out
        if len(new):
            self.pending.appendValue(pack(new[["series", "t", "cond"]].astype({"t": np.int64, "cond": bool})))
            first = int(new["t"].min()) // 1000
            if not any(x <= first for x in self.handle.listTimers()):
                self.handle.registerTimer(first)
        yield from ()  # a generator, though it gives nothing

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gone = timerValues.getCurrentWatermarkInMs()
        waiting = unpack(self.pending.get(), ["series", "t", "cond"])
        ready = (waiting["t"] // 1000 < gone).to_numpy(dtype=bool)
        carried = self.run.exists()
        open_runs = unpack([self.run.get()] if carried else [], ["series", "start", "t", "fired"])
        now, waiting = waiting[ready], waiting[~ready]
        # an open run goes first in its series; at one time, samples where it does not hold come first
        rows = pd.concat([x for x in (open_runs.assign(cond=True, first=0), now.assign(start=0, fired=False, first=1)) if len(x)],
                         ignore_index=True) if len(open_runs) + len(now) else pd.DataFrame()
        timers = {int(waiting["t"].min()) // 1000} if len(waiting) else set()
        left = pd.DataFrame()
        if len(rows):
            rows["code"] = pd.factorize(rows["series"])[0]
            rows = rows.sort_values(["code", "first", "t", "cond"], kind="stable", ignore_index=True)
            code, t, cond = rows["code"].to_numpy(), rows["t"].to_numpy(dtype=np.int64), rows["cond"].to_numpy(dtype=bool)
            same = np.r_[False, code[1:] == code[:-1]]
            begin = np.flatnonzero(cond & ~(same & np.r_[False, cond[:-1]]))
            stops = np.r_[np.flatnonzero(~cond | ~same), len(t)]
            stop = stops[np.searchsorted(stops, begin, "right")]
            ended = (stop < len(t)) & np.r_[same, False][stop]
            newest, was_fired = t[stop - 1], rows["fired"].to_numpy(dtype=bool)[begin]
            starts = np.where(rows["first"].to_numpy()[begin] == 0, rows["start"].to_numpy(dtype=np.int64)[begin], t[begin])
            if self.on_sample:
                held = newest - starts >= self.hold
            else:
                held = np.where(ended, np.r_[t, 0][stop] - starts >= self.hold, (starts + self.hold) // 1000 < gone)
            series, fire = rows["series"].to_numpy()[begin], held & ~was_fired
            if fire.any():
                yield pd.DataFrame({"series": [x[1:] for x in series[fire]], "run_start": pd.to_datetime(starts[fire], unit="us"),
                                    "fire_at": pd.to_datetime(starts[fire] + self.hold, unit="us")})
            left = pd.DataFrame({"series": series, "start": starts, "t": newest, "fired": held | was_fired})[~ended]
            due = left.loc[~left["fired"], "start"]
            if len(due) and not self.on_sample:
                timers.add(int(due.min() + self.hold) // 1000)
        if len(left):
            self.run.update(pack(left))
        elif carried:
            self.run.clear()
        if len(now):
            self.pending.put([pack(waiting)]) if len(waiting) else self.pending.clear()
        for x in timers - set(self.handle.listTimers()):
            self.handle.registerTimer(x)


def stream_alert_for(samples: DataFrame, series: str, ts: str, condition_col: str, hold_seconds: int,
                     delay: str = "0 seconds", on_sample: bool = False, slots: int = SLOTS) -> DataFrame:
    """M9: a run of samples where the condition holds fires once, at start + hold, when the watermark
    shows that it lasted that long; no further sample is needed. Runs are those of the batch
    ``alert_runs`` with the watermark as its ``as_of``. ``on_sample``: it fires only where a sample of
    the run itself lies ``hold`` after its start. A null condition does not hold. Samples behind the
    watermark are left out; rows without a series are ticks."""
    cols = watermarked(samples, ts, delay).select(
        slot(key_text(series), slots).alias("slot"), key_text(series).alias("series"), "t", F.coalesce(F.col(condition_col), F.lit(False)).alias("cond"))
    return cols.groupBy("slot").transformWithStateInPandas(HeldAlert(hold_seconds * 1_000_000, on_sample), ALERT_OUTPUT, "Append", "EventTime")


# ------------------------------------------------------------------ M8: heartbeats

BEAT_OUTPUT = StructType([StructField("series", StringType()), StructField("status", StringType()),
                          StructField("last_ts", TimestampNTZType())])


class Heartbeat(StatefulProcessor):
    """One series: its newest time, and one timer ``bound`` after it. ``by_clock``: the timer runs
    on the machine's clock from the batch that brought the series' last row."""

    def __init__(self, bound_ms: int, by_clock: bool):
        self.bound, self.by_clock = bound_ms, by_clock

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "t long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = pd.concat([pdf["t"] for pdf in rows]).dropna()
        if key[0] == "" or not len(times):
            return
        newest = int(times.max())
        if self.last.exists():
            newest = max(newest, self.last.get()[0])
        self.last.update((newest,))
        for x in list(self.handle.listTimers()):
            self.handle.deleteTimer(x)
        since = timerValues.getCurrentProcessingTimeInMs() if self.by_clock else newest // 1000
        self.handle.registerTimer(since + self.bound)
        yield from ()  # a generator, though it gives nothing

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0]
        self.last.clear()
        yield pd.DataFrame({"series": [key[0][1:]], "status": ["stale"], "last_ts": [pd.to_datetime(last, unit="us")]})


def stream_heartbeat(samples: DataFrame, series: str, ts: str, bound: str, delay: str = "0 seconds",
                     by_clock: bool = False) -> DataFrame:
    """M8: a series that stops reporting is reported ``stale`` once and forgotten until it reports
    again. By event time: when the watermark passes its newest row plus ``bound``, that is, while
    others still report. ``by_clock``: when the clock has moved by ``bound`` since the batch of its last
    row, also when every series has fallen silent and no row moves the watermark."""
    bound_ms = int(pd.Timedelta(bound).total_seconds() * 1000)
    cols = (with_state_store(samples).withColumn("t", micros(ts)) if by_clock else watermarked(samples, ts, delay))
    cols = cols.select(key_text(series).alias("series"), "t")
    return cols.groupBy("series").transformWithStateInPandas(
        Heartbeat(bound_ms, by_clock), BEAT_OUTPUT, "Append", "ProcessingTime" if by_clock else "EventTime")
