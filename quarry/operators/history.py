"""Per-user search history as keyed state, plus profile and document upserts.

``save(q)``: insert q at the front when absent, keep the newest 10; a repeat
does not move q.  ``delete(q)``: remove q when present, else count a miss
(the original answers "not found").  Blank queries are ignored.

Batch form: events are hash-partitioned by user and sorted by (user, ts,
event_id) inside each partition; one pass over each sorted partition carries
a bounded state (10 items) per user, so no user's events are ever gathered
into one array or one in-memory group and the sort spills as needed.  The
stream form (``quarry.streaming``) applies the same step function per
micro-batch with the state kept by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------
MAX_HISTORY = 10
SAVE = "save"
DELETE = "delete"
# ---------------------------------------------------------------------------

STATE_SCHEMA = "username string, history array<string>, saves long, missing_deletes long"


def apply_event(history: list[str], op: str, q: str | None, max_len: int = MAX_HISTORY) -> tuple[list[str], bool]:
    """One step of the state machine; returns (new history, missed delete)."""
    if q is None or not str(q).strip():
        return history, False
    if op == SAVE:
        if q not in history:
            history = [q] + history
        return history[:max_len], False
    if op == DELETE:
        if q in history:
            return [x for x in history if x != q], False
        return history, True
    return history, False


def _fold_sorted(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cur = None
    hist: list[str] = []
    saves = misses = 0
    out: list[tuple] = []
    for pdf in it:
        for user, op, q in zip(pdf["username"], pdf["op"], pdf["query"]):
            if user != cur:
                if cur is not None:
                    out.append((cur, hist, saves, misses))
                cur, hist, saves, misses = user, [], 0, 0
            hist, missed = apply_event(hist, op, q)
            saves += op == SAVE
            misses += missed
        if len(out) >= 10000:
            yield pd.DataFrame(out, columns=["username", "history", "saves", "missing_deletes"])
            out = []
    if cur is not None:
        out.append((cur, hist, saves, misses))
    if out:
        yield pd.DataFrame(out, columns=["username", "history", "saves", "missing_deletes"])


def history_fold(events: DataFrame, order: tuple[str, ...] = ("ts", "event_id"), partitions: int | None = None) -> DataFrame:
    """``(username, history, saves, missing_deletes)`` from events
    ``(username, op, query, *order)`` in ``order``."""
    ev = events.select("username", "op", "query", *order).filter(F.coalesce("query", F.lit("")).rlike(r"[^\s\p{Z}]"))
    parts = [partitions] if partitions else []
    ordered = ev.repartition(*parts, "username").sortWithinPartitions("username", *order)
    return ordered.select("username", "op", "query").mapInPandas(_fold_sorted, STATE_SCHEMA)


def history_lookup(requests: DataFrame, state: DataFrame) -> DataFrame:
    """``(username, history)``: the user's list or ``[]``."""
    s = state.select("username", "history")
    return requests.select("username").join(s, "username", "left").select(
        "username", F.coalesce("history", F.array().cast("array<string>")).alias("history")
    )


def history_profile(state: DataFrame, users: DataFrame) -> DataFrame:
    """History rows enriched with the user's college and major (left join:
    a user without a profile gets NULLs)."""
    return state.join(users.select("username", "college", "major"), "username", "left").select(
        "username", "college", "major", "history"
    )


def upsert_latest(base: DataFrame, updates: DataFrame, key: str | list[str], seq: str = "seq") -> DataFrame:
    """Keyed upsert, last write wins: the row with the highest ``seq`` per
    key over ``base`` union ``updates`` (updates win ties).  One shuffle by
    key; partial aggregation keeps a hot key to one row per map task."""
    keys = [key] if isinstance(key, str) else list(key)
    u = base.withColumn("_src", F.lit(0)).unionByName(updates.withColumn("_src", F.lit(1)))
    other = [c for c in u.columns if c not in keys]
    latest = u.groupBy(*keys).agg(F.max_by(F.struct(*other), F.struct(seq, "_src")).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in other if c != "_src"])


def insert_new(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """Register only unknown keys: candidates not in ``existing`` (first
    candidate per key by ``seq``), appended to ``existing``."""
    other = [c for c in candidates.columns if c != key]
    first = candidates.groupBy(key).agg(F.min_by(F.struct(*other), "seq").alias("_r")).select(
        key, *[F.col(f"_r.{c}").alias(c) for c in other]
    )
    new = first.join(existing.select(key), key, "left_anti")
    return existing.unionByName(new.select(*existing.columns))
