"""History state as a Structured Streaming job.

Events ``(username, op, query, ts, event_id)`` arrive as a stream; state per
user (the history list and two counters) is kept by Spark's state store and
updated with the same step function as the batch fold.  Inside a
micro-batch a user's events are applied in (ts, event_id) order; across
micro-batches in arrival order.  Output mode ``update``: one row per user
whose state changed in the batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quarry.operators.history import SAVE, STATE_SCHEMA, apply_event

_STATE = StructType(
    [
        StructField("history_json", StringType()),
        StructField("saves", LongType()),
        StructField("missing_deletes", LongType()),
    ]
)


def _step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (user,) = key
    if state.exists:
        hist_json, saves, misses = state.get
        hist = json.loads(hist_json)
    else:
        hist, saves, misses = [], 0, 0
    # one user's rows of one micro-batch, bounded by the trigger size
    pdf = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "event_id"], kind="stable")
    for op, q in zip(pdf["op"], pdf["query"]):
        if q is None or not str(q).strip():
            continue
        hist, missed = apply_event(hist, op, q)
        saves += op == SAVE
        misses += missed
    state.update((json.dumps(hist), int(saves), int(misses)))
    yield pd.DataFrame({"username": [user], "history": [hist], "saves": [int(saves)], "missing_deletes": [int(misses)]})


def history_stream(events: DataFrame) -> DataFrame:
    """Streaming ``(username, history, saves, missing_deletes)`` updates."""
    ev = events.select("username", "op", "query", "ts", "event_id")
    return ev.groupBy("username").applyInPandasWithState(
        _step, STATE_SCHEMA, _STATE, "update", GroupStateTimeout.NoTimeout
    )
