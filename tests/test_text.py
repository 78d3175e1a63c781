from pyspark.sql import functions as F

from weftline.functions.text import explode_words, split_words, words_of_text

LINES = ["nihao gu shuai xuan", "wo zhen de ai ni", "wo bu pa de bu dao ni", "gu shuai xuan"]


def test_split_keeps_inner_and_drops_trailing_empty_words(spark):
    cases = {"a b": ["a", "b"], "a  b ": ["a", "", "b"], " a": ["", "a"], "": [""], "   ": [], "a\t ": ["a\t"]}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "line string, want array<string>")
    for row in df.select("line", "want", split_words(F.col("line")).alias("got")).collect():
        assert row.got == row.want, row


def test_trimmed_split_strips_control_characters(spark):
    cases = {"\t a b \r": ["a", "b"], "  ": [""], "": [""], "a  b": ["a", "", "b"]}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "line string, want array<string>")
    for row in df.select("line", "want", split_words(F.col("line"), trim=True).alias("got")).collect():
        assert row.got == row.want, row


def test_word_count_of_sample_lines(spark, rows):
    df = spark.createDataFrame([(line,) for line in LINES], "value string")
    counts = dict(rows(explode_words(df, "value").groupBy("word").count()))
    assert counts == {
        "ai": 1, "bu": 2, "dao": 1, "de": 2, "gu": 2, "ni": 2, "nihao": 1, "pa": 1, "shuai": 2,
        "wo": 2, "xuan": 2, "zhen": 1,
    }


def test_whole_text_is_split_into_lines(spark):
    text = "\n".join(["one two"] * 5000 + [""])
    df = spark.createDataFrame([(1, text)], "id int, text string")
    assert words_of_text(df, "text", "id").count() == 10001
