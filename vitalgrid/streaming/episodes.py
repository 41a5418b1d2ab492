"""Alerts as episodes: one row when a condition sets in and one when it ends, from state kept per location.

A location's state holds the hours that the watermark has not passed yet, and its open alerts with their length and peak.
Hours are taken in order of time once the watermark is beyond them, however they arrived; an event-time timer on the
earliest waiting hour makes sure that a location that falls silent is looked at again. The state is bounded by the delay,
not by the length of the stream. Missing hours come from the same state: every hour of the spine between two hours taken.
"""

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .hourly import WATERMARK, event_time

EVENTS = "location string, type string, event string, timestamp timestamp, hours long, peak double"
GAPS = "location string, timestamp timestamp"
STATE = "held string"
HOUR = 3_600_000
# an alert whose location sends nothing for longer than this is over
SILENCE_HOURS = 6


def conditions(merged: DataFrame) -> DataFrame:
    """location, timestamp and, per type of alert, its value while the condition holds, else NULL."""
    aqi, pm25, t = F.col("aqi"), F.col("pm25"), F.col("temperature")
    return merged.select(
        "location", "timestamp", F.when(aqi > 150, aqi).alias("air_quality"), F.when(pm25 > 50, pm25).alias("pm25"),
        F.when((t > 35) | (t < 5), t).alias("temperature"),
    )


def _taken(frames, state: GroupState, held: dict, make):
    """The hours of the state and of the new rows that the watermark has passed, in order; the others stay held."""
    waiting = {int(k): v for k, v in held.get("waiting", {}).items()}
    for frame in frames:
        for at, value in zip(frame["timestamp"].astype("datetime64[ms]").astype("int64"), make(frame)):
            waiting[int(at)] = value
    mark = state.getCurrentWatermarkMs()
    done = sorted(at for at in waiting if at < mark)
    held["waiting"] = {str(at): v for at, v in waiting.items() if at >= mark}
    if held["waiting"]:
        state.setTimeoutTimestamp(min(int(at) for at in held["waiting"]))
    return [(at, waiting[at]) for at in done]


def _held(state: GroupState) -> dict:
    return json.loads(state.get[0]) if state.exists else {}


def _episodes(types: tuple[str, ...], silence: int):
    def values(frame):
        return [
            [None if pd.isna(v) else float(v) for v in row] for row in frame[list(types)].itertuples(index=False, name=None)
        ]

    def run(key, frames, state: GroupState):
        held = _held(state)
        opened = held.setdefault("open", {})
        out = []

        def ends(name, at):
            begun = opened.pop(name)
            out.append((key[0], name, "end", at, begun["hours"], begun["peak"]))

        for at, row in _taken([] if state.hasTimedOut else frames, state, held, values):
            quiet = at - held.get("last", at) > silence * HOUR
            for name, value in zip(types, row):
                if name in opened and quiet:
                    ends(name, held["last"])
                if value is None:
                    if name in opened:
                        ends(name, at)
                elif name in opened:
                    known = opened[name]
                    known["hours"], known["peak"] = known["hours"] + 1, max(known["peak"], value)
                else:
                    opened[name] = {"hours": 1, "peak": value}
                    out.append((key[0], name, "onset", at, 1, value))
            held["last"] = at
        state.update((json.dumps(held),))
        if out:
            found = pd.DataFrame(out, columns=["location", "type", "event", "timestamp", "hours", "peak"])
            found["timestamp"] = pd.to_datetime(found["timestamp"], unit="ms")
            yield found

    return run


def _gaps(key, frames, state: GroupState):
    held = _held(state)
    out = []
    for at, _ in _taken([] if state.hasTimedOut else frames, state, held, lambda f: [0] * len(f)):
        out += range(held.get("last", at) + HOUR, at, HOUR)
        held["last"] = at
    state.update((json.dumps(held),))
    if out:
        yield pd.DataFrame({"location": [key[0]] * len(out), "timestamp": pd.to_datetime(out, unit="ms")})


def _by_location(stream: DataFrame, run, schema: str) -> DataFrame:
    found = stream.groupBy("location").applyInPandasWithState(
        run, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return found.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def stream_episodes(merged: DataFrame, watermark: str = WATERMARK, silence: int = SILENCE_HOURS) -> DataFrame:
    """location, type, event (onset or end), timestamp, hours and peak so far, of a stream of merged hours.

    An alert ends at the first hour without its condition, or with its last hour when the location then sent nothing
    for more than `silence` hours. Of two rows of one location and hour the later one to arrive counts.
    """
    rows = event_time(conditions(merged), watermark)
    types = tuple(c for c in rows.columns if c not in ("location", "timestamp"))
    return _by_location(rows, _episodes(types, silence), EVENTS)


def stream_gaps(hours: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """location, timestamp of every hour without a row between two hours of a location that the watermark has passed.

    `hours` is a stream with few rows per location and hour, as merged hours are; only its times are looked at.
    """
    rows = hours.select("location", F.date_trunc("hour", "timestamp").alias("timestamp"))
    return _by_location(event_time(rows, watermark), _gaps, GAPS)
