"""Storage, fragments and escapes: what a second reading of the engine asked for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry import session
from quarry.functions import text as T
from quarry.operators import common as C
from quarry.operators import highlight as HL
from quarry.operators import pages as P
from quarry.operators.index import STANDARD, Dictionary, build_index, read_index, write_index
from quarry.sources import files as IO
from quarry.sources import tables as src

SF = "/root/testdata/sf0.001"


def test_history_file_round_trip(spark, tmp_path):
    rows = [("ann", "c", None, ["q1", "q2"]), ("bob", None, "m", [])]
    df = spark.createDataFrame(rows, "username string, college string, major string, history array<string>")
    IO.write_history(df, str(tmp_path / "h"))
    assert sorted((r.username, r.college, r.major, r.history) for r in IO.read_history(spark, str(tmp_path / "h")).collect()) == rows
    (tmp_path / "map.json").write_text('{"ann": {"username": "ann", "college": "c", "major": null, "history": ["q1", "q2"]}}')
    assert [r.history for r in IO.read_history(spark, str(tmp_path / "map.json")).collect()] == [["q1", "q2"]]
    (tmp_path / "broken.json").write_text('{"ann": ')
    assert IO.read_history(spark, str(tmp_path / "broken.json")).count() == 0


def test_smaller_rebuild_leaves_no_old_posting(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i} common") for i in range(40)], "doc_id long, content string")
    write_index(build_index(docs, {"content": STANDARD}), str(tmp_path / "i"), term_buckets=4)
    write_index(build_index(docs.filter("doc_id = 3"), {"content": STANDARD}), str(tmp_path / "i"), term_buckets=4)
    got = read_index(spark, str(tmp_path / "i"), {"content": STANDARD})
    assert sorted(r.term for r in got.postings.collect()) == ["common", "word3"] and got.term_stats.count() == 2


def test_search_reads_stored_statistics(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, content string")
    index = build_index(docs, {"content": STANDARD})
    for df in (index.field_stats, index.term_stats, index.doc_len):
        assert "Aggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_is_required_off_the_local_master(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


@pytest.mark.parametrize("pattern,yes,no", [("a*", ["a", "abc"], ["ba"]), ("?b", ["ab"], ["b"]), (r"a\*", ["a*"], ["ab"]), (r"\?.", ["?."], ["a.", "?x"]), ("a.b", ["a.b"], ["axb"]), (r"x\\y", [r"x\y"], ["xy"])])
def test_wildcards_and_escapes(spark, pattern, yes, no):
    df = spark.createDataFrame([(w, pattern) for w in yes + no], "w string, p string")
    got = {r.w for r in df.filter(F.regexp_like("w", T.wildcard_to_regex("p"))).collect()}
    assert got == set(yes)


def test_fragments_are_short_whole_and_marked(spark):
    text = "Plain first. " + "<strong>hit</strong> " + "filler words " * 30 + "<strong>hit</strong> end. No mark here at all. Two <strong>hit</strong>, 3.14 <strong>x</strong>! tail"
    rows = spark.createDataFrame([(1, 1, "content", text), (1, 2, "content", "。" + "<strong>东</strong>方。后")], "query_id long, doc_id long, field string, fragment string")
    got = {r.doc_id: r.fragments for r in HL.highlight_fragments(rows).collect()}
    assert len(got[1]) == 3 and got[1][2] == "Two <strong>hit</strong>, 3.14 <strong>x</strong>!" and got[2] == ["<strong>东</strong>方。"]
    for f in got[1]:
        assert f.count("<strong>") == f.count("</strong>") > 0 and len(f.replace("<strong>", "").replace("</strong>", "")) <= HL.FRAGMENT_SIZE


def test_parse_errors_are_told(spark, monkeypatch):
    monkeypatch.setattr(P._PageParser, "close", lambda self: 1 / 0)
    assert P.parse_html("<p>x")["error"].startswith("ZeroDivisionError")
    pages = spark.createDataFrame([(1, "u", "<title>t</title>")], "page_id long, url string, html string")
    monkeypatch.undo()
    assert P.parse_errors(P.parse_pages(pages)).count() == 0


def test_dictionary_fields_are_marked(spark):
    docs = spark.createDataFrame([(1, "看东方红日 and 东风", "东方"), (2, "nothing", "")], "doc_id long, content string, title string")
    words = spark.createDataFrame([("东方",), ("方红",), ("东风",)], "word string")
    index = build_index(docs, {"content": Dictionary(words), "title": Dictionary(words)})
    patterns = spark.createDataFrame([(7, "东?"), (8, "?红")], "query_id long, query string")
    hits = spark.createDataFrame([(7, 1), (8, 1)], "query_id long, doc_id long")
    got = {(r.query_id, r.field): r.fragment for r in HL.highlight(index, hits, patterns, ["title", "content"], words=False, patterns=patterns).collect()}
    assert got == {(7, "content"): "看<strong>东方</strong>红日 and <strong>东风</strong>", (7, "title"): "<strong>东方</strong>", (8, "content"): "看东<strong>方红</strong>日 and 东风"}
    both = spark.createDataFrame([(7, "content", "东方"), (7, "content", "方红")], "query_id long, field string, term string")
    got = [r.fragment for r in HL.highlight_runs(index, hits.limit(1), both, ["content"]).collect()]
    assert got == ["看<strong>东方红</strong>日 and 东风"]


def test_broadcast_only_when_rows_and_bytes_are_small(spark):
    def broadcast(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    df = spark.createDataFrame([(i, "x" * 1000) for i in range(10)], "a long, b string")
    assert broadcast(C.bounded_broadcast(df)) and not broadcast(C.bounded_broadcast(df, max_rows=9)) and not broadcast(C.bounded_broadcast(df, max_bytes=9_000))


def test_fingerprint_sees_files_rewritten_in_a_folder(spark, tmp_path):
    df = spark.range(5)
    df.write.parquet(str(tmp_path / "t.parquet"))
    one = src.fingerprint(spark, str(tmp_path), ["t"])
    df.union(df).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert one and src.fingerprint(spark, f"file://{tmp_path}", ["t"]) != one
