import datetime
import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators import history as H
from quarry.streaming.history import history_stream


def seq_fold(events):
    out = {}
    for user, op, q in events:
        h, s, m = out.get(user, ([], 0, 0))
        h, missed = H.apply_event(h, op, q)
        out[user] = (h, s + (op == H.SAVE), m + missed)
    return out


def test_step_function():
    h = []
    for q in [str(i) for i in range(11)]:
        h, _ = H.apply_event(h, H.SAVE, q)
    assert h == [str(i) for i in range(10, 0, -1)]  # the first item was evicted
    h2, _ = H.apply_event(h, H.SAVE, "5")  # repeat: no move
    assert h2 == h
    h3, _ = H.apply_event(h, H.SAVE, "0")  # evicted item comes back at the front
    assert h3[0] == "0" and len(h3) == 10
    h4, missed = H.apply_event(h3, H.DELETE, "zz")
    assert h4 == h3 and missed
    h5, missed = H.apply_event(h3, H.DELETE, "0")
    assert h5 == h3[1:] and not missed
    assert H.apply_event(h5, H.SAVE, "  ")[0] == h5


EVENTS = [
    ("u1", "save", "a"), ("u1", "save", "b"), ("u1", "save", "a"), ("u1", "delete", "b"), ("u1", "delete", "x"),
    ("u2", "save", "q"), ("u2", "save", " "),
] + [("u3", "save", str(i % 13)) for i in range(40)] + [("u3", "delete", "12"), ("u3", "save", "12")]


def events_df(spark):
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(u, op, q, t0 + datetime.timedelta(seconds=i // 2), i) for i, (u, op, q) in enumerate(EVENTS)]
    return spark.createDataFrame(rows, "username string, op string, query string, ts timestamp_ntz, event_id long")


def test_batch_fold_equals_sequential(spark):
    want = seq_fold([e for e in EVENTS if e[2].strip()])
    got = {r.username: (r.history, r.saves, r.missing_deletes) for r in H.history_fold(events_df(spark), partitions=2).collect()}
    assert got == {u: (h, s, m) for u, (h, s, m) in want.items()}
    assert all(len(v[0]) <= 10 and len(set(v[0])) == len(v[0]) for v in got.values())


def test_stream_equals_batch(spark):
    ev = events_df(spark)
    batch = {r.username: (r.history, r.saves, r.missing_deletes) for r in H.history_fold(ev).collect()}
    d = tempfile.mkdtemp(prefix="quarry-hist-")
    # three files, read one per micro-batch, in event order
    for i, (lo, hi) in enumerate([(0, 10), (10, 30), (30, len(EVENTS))]):
        ev.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.parquet(f"{d}/in/part={i}")
    stream_in = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in/part=*")
    q = (history_stream(stream_in).writeStream.outputMode("update").format("memory").queryName("hist_out")
         .option("checkpointLocation", f"{d}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(300)
    rows = spark.sql("SELECT * FROM hist_out").collect()
    last = {}
    for r in rows:  # the newest update per user is its state
        cur = last.get(r.username)
        if cur is None or r.saves + r.missing_deletes >= cur.saves + cur.missing_deletes:
            last[r.username] = r
    got = {u: (r.history, r.saves, r.missing_deletes) for u, r in last.items()}
    assert got == batch


def test_upserts(spark):
    base = spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], "username string, college string, seq int")
    upd = spark.createDataFrame([("a", "z", 2), ("c", "w", 2)], "username string, college string, seq int")
    got = {r.username: r.college for r in H.upsert_latest(base, upd, "username").collect()}
    assert got == {"a": "z", "b": "y", "c": "w"}
    cands = spark.createDataFrame([("a", "new", 1), ("d", "first", 1), ("d", "second", 2)], "username string, college string, seq int")
    ins = {r.username: r.college for r in H.insert_new(base.drop("seq"), cands, "username").collect()}
    assert ins == {"a": "x", "b": "y", "d": "first"}


def test_lookup_and_profile(spark):
    st = spark.createDataFrame([("a", ["q1"])], "username string, history array<string>")
    req = spark.createDataFrame([("a",), ("zz",)], "username string")
    assert {r.username: r.history for r in H.history_lookup(req, st).collect()} == {"a": ["q1"], "zz": []}
    users = spark.createDataFrame([("a", "c", "m")], "username string, college string, major string")
    assert H.history_profile(st, users).collect()[0].asDict() == {"username": "a", "college": "c", "major": "m", "history": ["q1"]}
