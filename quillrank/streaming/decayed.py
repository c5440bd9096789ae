"""Live click-through rates whose exposures and clicks fade: keyed state with a time-out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillrank.streaming.counters import LATE

SUMS = "last long, exposure double, click double"


def _united(last: np.ndarray, sums: np.ndarray, half_life: float) -> tuple[int, np.ndarray]:
    """Faded sums (one row per time) at the latest of the times, in microseconds; any order of rows gives the same."""
    now = int(last.max())
    return now, (np.exp2((last - now) / (half_life * 1e6))[:, None] * sums).sum(axis=0)


def decayed_ctr(
    hits: DataFrame, ts: str, key: str, clicked: str, half_life: float, time_out: float, late: str = LATE
) -> DataFrame:
    """(key, last, exposure, click, ctr) on a stream, for update mode: sums faded by half each ``half_life`` seconds.

    Sums are those at ``last``, the newest event of the key. Every task first reduces each of its batches to one row a key,
    so a hot key sends few rows to its state. A key without events for ``time_out`` seconds behind the watermark loses its
    state and starts anew; what comes later than ``late`` is left out, as the watermark says. Rows without key or time are
    left out; a null click is none.
    """
    kind = hits.schema[key].dataType.simpleString()

    def reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, part in frame.groupby("key", sort=False):
                sums = np.column_stack([np.ones(len(part)), part["click"].to_numpy(dtype=float)])
                now, total = _united(part["at"].to_numpy(dtype=np.int64), sums, half_life)
                rows.append((name, now, *total))
            yield pd.DataFrame(rows, columns=["key", "last", "exposure", "click"])

    def updated(name: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known = [state.get] if state.exists else []
        for frame in frames:
            known += list(zip(frame["at"], frame["exposure"], frame["click"]))
        now, total = _united(np.array([k[0] for k in known], dtype=np.int64), np.array([k[1:] for k in known], dtype=float), half_life)
        state.update((now, float(total[0]), float(total[1])))
        due = now // 1000 + int(time_out * 1000)
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [name[0]], "last": [now], "exposure": [total[0]], "click": [total[1]]})

    plain = hits.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"),
        F.coalesce(F.col(clicked).cast("double"), F.lit(0.0)).alias("click"),
    )
    parts = plain.mapInPandas(reduced, f"key {kind}, {SUMS}").select(
        "key", F.col("last").alias("at"), "exposure", "click", F.timestamp_micros("last").alias("time")
    )
    live = parts.withWatermark("time", late).groupBy("key").applyInPandasWithState(
        updated, f"key {kind}, {SUMS}", SUMS, "update", GroupStateTimeout.EventTimeTimeout
    )
    return live.select(
        F.col("key").alias(key), F.timestamp_micros("last").alias("last"), "exposure", "click",
        (F.col("click") / F.col("exposure")).alias("ctr"),
    )
