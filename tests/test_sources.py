import datetime
import os
import tempfile

from quarry.sources import files as IO


def test_state_files(spark):
    d = tempfile.mkdtemp(prefix="quarry-state-")
    good = os.path.join(d, "users.json")
    with open(good, "w", encoding="utf-8") as f:
        f.write('{"a": {"username": "a", "password": "secret", "college": "c", "major": "m"}, "b": {"username": "b"}}')
    empty = os.path.join(d, "empty.json")
    open(empty, "w").close()
    broken = os.path.join(d, "broken.json")
    with open(broken, "w") as f:
        f.write("{not json")
    users = {r.username: (r.college, r.major) for r in IO.read_users(spark, good).collect()}
    assert users == {"a": ("c", "m"), "b": (None, None)}
    assert "password" not in IO.read_users(spark, good).columns
    assert IO.read_users(spark, empty).count() == 0
    assert IO.read_users(spark, broken).count() == 0
    assert IO.read_history(spark, os.path.join(d, "missing.json")).count() == 0


def test_round_trips(spark):
    d = tempfile.mkdtemp(prefix="quarry-io-")
    tu = spark.createDataFrame([("t1", "u1"), ("标题", "u2")], "title string, url string")
    IO.write_title_url(tu, f"{d}/title_url")
    assert sorted(tuple(r) for r in IO.read_title_url(spark, f"{d}/title_url").collect()) == sorted(tuple(r) for r in tu.collect())
    recs = spark.createDataFrame(
        [("u", "标题", "", datetime.datetime(2024, 1, 2, 3, 4), "", "", "1", "正文", ["l1", "l1"], 0.5),
         ("v", "t", "", None, "", "", "", "", [], 0.0)],
        "url string, title string, source string, publish_time timestamp_ntz, editor string, period string, "
        "readcount string, content string, links array<string>, pagerank double",
    )
    IO.write_records_json(recs, f"{d}/json")
    back = {r.url: r for r in IO.read_records_json(spark, f"{d}/json").collect()}
    assert back["u"].publish_time == datetime.datetime(2024, 1, 2, 3, 4) and back["u"].links == ["l1", "l1"]
    assert back["v"].publish_time is None
    IO.write_records_csv(recs, f"{d}/csv")
    assert spark.read.option("header", True).csv(f"{d}/csv").count() == 2
    assert IO.write_rejects(recs.limit(0), f"{d}/rejects") is False and not os.path.exists(f"{d}/rejects")
    assert IO.write_rejects(recs.select("url"), f"{d}/rejects") is True
    IO.create_if_absent(tu, f"{d}/tbl")
    IO.create_if_absent(tu.limit(1), f"{d}/tbl")
    assert spark.read.parquet(f"{d}/tbl").count() == 2


def test_html_dir(spark):
    d = tempfile.mkdtemp(prefix="quarry-html-")
    for n in ("a", "b"):
        with open(f"{d}/{n}.html", "w", encoding="utf-8") as f:
            f.write(f"<html><title>{n}</title></html>")
    rows = IO.scan_html_dir(spark, d).collect()
    assert sorted(os.path.basename(r.file) for r in rows) == ["a.html", "b.html"]
