"""ST-1: the current status of each facility from a stream of status events."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "observed_at long, seq long, status string, expires_at long"
OUT = "facility_id long, observed_at long, seq long, status string, expires_at long"


def _update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keeps the latest (observed_at, seq); emits it when it changes, and UNKNOWN once its validity is over."""
    shape = ["facility_id", "observed_at", "seq", "status", "expires_at"]
    if state.hasTimedOut:
        at, seq, _, expires = state.get
        state.update((at, seq, "UNKNOWN", expires))
        yield pd.DataFrame([[key[0], at, seq, "UNKNOWN", expires]], columns=shape)
        return
    best: Any = state.get if state.exists else None
    before = best
    for b in batches:
        for r in b[["observed_at", "seq", "status", "expires_at"]].itertuples(index=False):
            if best is None or (r.observed_at, r.seq) > (best[0], best[1]):
                best = (int(r.observed_at), int(r.seq), r.status, int(r.expires_at))
    if best != before:
        if best[3] * 1000 <= state.getCurrentWatermarkMs():
            best = (best[0], best[1], "UNKNOWN", best[3])
        state.update(best)
        yield pd.DataFrame([[key[0], *best]], columns=shape)
    if best[2] != "UNKNOWN":
        state.setTimeoutTimestamp(max(best[3] * 1000, state.getCurrentWatermarkMs() + 1))


def current_status(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """A streaming DataFrame (facility_id, status, observed_at, seq, expires_at as epoch seconds) to updates of the current status. Older
    late events change nothing; ties go to the later seq. State is one row a facility; an event-time timer ends its validity."""
    rows = events.withColumn("event_time", F.timestamp_seconds("observed_at")).withWatermark("event_time", lateness)
    return rows.groupBy("facility_id").applyInPandasWithState(_update, OUT, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def status_at(events: DataFrame, at: int) -> DataFrame:
    """The same as of an instant, in batch: the latest event up to it per facility; UNKNOWN at or after its expiry."""
    last = events.where(F.col("observed_at") <= at).groupBy("facility_id").agg(F.max(F.struct("observed_at", "seq", "status", "expires_at")).alias("m"))
    return last.select("facility_id", "m.observed_at", "m.seq", F.when(F.col("m.expires_at") <= at, "UNKNOWN").otherwise(F.col("m.status")).alias("status"), "m.expires_at")
