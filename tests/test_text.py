from pyspark.sql import functions as F

from quarry.functions import text as T


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_standard_tokens(spark):
    assert one(spark, T.standard_tokens("v"), "Hello, WORLD-2024 东方a大学!") == ["hello", "world", "2024", "东", "方", "a", "大", "学"]
    assert one(spark, T.standard_tokens("v"), "") == []


def test_url_tokens(spark):
    assert one(spark, T.url_tokens("v"), "http://News.Example.cn/a_b/12.shtml?x=1") == [
        "http", "news.example.cn", "a_b", "12.shtml", "x", "1"]


def test_keys(spark):
    assert one(spark, T.title_key("v"), "a?b”c:d/e“f g") == "a_b_c_d_e_f g"
    assert one(spark, T.snapshot_key("v"), "a?b c") == "a_bc"


def test_record_title_and_normalize(spark):
    t = "标题 一　-示例大学-综合新闻"
    assert one(spark, T.record_title("v", ["-示例大学", "-综合新闻"]), t) == "标题 一"
    assert one(spark, T.normalize_text("v"), "a b　c\r\nd\te") == "a bcde"
    assert one(spark, T.clean_editor("v"), "编辑：张 三\n") == "张三"


def test_parse_publish_time(spark):
    got = spark.createDataFrame([("2024-01-02 03:04",), ("2024-1-2 3:4",), ("2024-02-30 03:04",), ("",), ("x",)], "v string") \
        .select(T.parse_publish_time("v").cast("string").alias("r")).collect()
    assert [r.r for r in got] == ["2024-01-02 03:04:00", "2024-01-02 03:04:00", None, None, None]


def test_wildcard_to_regex(spark):
    rows = spark.createDataFrame(
        [("ab*", "abcd", True), ("a?c", "abc", True), ("a?c", "abbc", False), ("a.c", "abc", False), ("a.c", "a.c", True),
         ("(x)*", "(x)yz", True), ("*b*", "abc", True), ("a+", "aa", False)],
        "p string, t string, want boolean",
    )
    got = rows.withColumn("rx", T.wildcard_to_regex("p")).select("want", F.expr("t rlike rx").alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_py_strip(spark):
    assert one(spark, T.py_strip("v"), "　 a b  \n") == "a b"
