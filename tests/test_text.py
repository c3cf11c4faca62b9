import pytest
from pyspark.sql import functions as F

from tallyforge.functions import text as T


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("shown", "amount"),
    [("$1,234", 1234), ("(500)", -500), ("1,234.56", 1235), ("−3", -3), ("-7", -7), ("2.5", 2), ("3.5", 4), ("", None), ("-", None), ("—", None), ("$", None), ("$(500)", None), ("(1,234", None), ("n/a", None), ("12d", None), (" ( 5 ) ", -5), ("1 2", 12), ("(-5)", -5)],
)
def test_money(spark, shown, amount):
    assert one(spark, T.money(F.col("a")), a=shown) == amount


def test_number_keeps_inner_spaces(spark):
    assert one(spark, T.number(F.col("a")), a="1 2") is None
    assert one(spark, T.number(F.col("a")), a="(1,200)") == -1200


def test_money_near_takes_the_first_of_three(spark):
    assert one(spark, T.money_near(F.array(F.lit("x"), F.lit("$"), F.lit("5"), F.lit("6")), F.lit(1))) == 5
    assert one(spark, T.money_near(F.array(F.lit("x")), F.lit(3))) is None


def test_clean_and_suffixes(spark):
    assert one(spark, T.clean(F.col("a")), a=" a  b\n c ") == "a b c"
    assert one(spark, T.clean_line(F.col("a")), a="Online stores (1)") == "Online stores"
    assert one(spark, T.clean_line(F.col("a")), a="Family of Apps (FoA)") == "Family of Apps (FoA)"
    assert one(spark, T.clean_segment(F.col("a")), a="Family  of Apps (FoA)") == "Family of Apps"


def test_tokens_and_overlap(spark):
    assert sorted(one(spark, T.tokens(F.col("a")), a="Wearables, Home and Accessories (1)")) == ["accessories", "home", "wearables"]
    assert one(spark, T.overlap(T.tokens(F.lit("Services")), T.tokens(F.lit("Google Services")))) == 1.0
    assert one(spark, T.overlap(T.tokens(F.lit("")), T.tokens(F.lit("Google")))) == 0.0


def test_accounting_sentences_go(spark):
    text = "Page 3 We sell phones. Revenue is recognized when shipped. Phones are small."
    assert one(spark, T.without_accounting(F.col("a")), a=text) == "We sell phones. Phones are small."


def test_section_and_note(spark):
    text = "x Item 7 Management " + "a" * 600 + " Item 8 rest"
    got = one(spark, T.section(F.col("a"), "(?i)item 7"), a=text)
    assert got == text[2 : text.index("Item 8")]
    assert one(spark, T.section(F.col("a"), "(?i)item 9"), a=text) == ""
    assert one(spark, T.note2(F.col("a")), a="zz Note 2 - Revenue " + "b" * 200 + " Note 3 x").rstrip().endswith("b")
    assert one(spark, T.note2(F.col("a")), a="none") is None


def test_json_body_and_retry(spark):
    assert one(spark, T.json_body(F.col("a")), a='```json\n{"a": {"b": 1}}\n```') == '{"a": {"b": 1}}'
    assert one(spark, T.json_body(F.col("a")), a='Sure: {"a": 1} bye') == '{"a": 1}'
    assert one(spark, T.retry_seconds(F.col("a")), a="please try again in 1.5s") == 1.5


def test_headings_and_marks(spark):
    assert one(spark, T.heading(F.col("a")), a="OUR BUSINESS\ntext") == "OUR BUSINESS"
    assert one(spark, T.heading(F.col("a")), a="Reality Labs\ntext") == "Reality Labs"
    assert one(spark, T.heading(F.col("a")), a="this is plain text") is None
    assert one(spark, T.is_table_header(F.col("a")), a="2024 2023 2022 of things")
    assert not one(spark, T.is_table_header(F.col("a")), a="Phones and tablets")
    assert one(spark, T.sheet_name(F.col("a")), a="a/b:" + "c" * 40) == "a_b_" + "c" * 27


def test_search_terms(spark):
    got = one(spark, T.search_terms(F.col("a")), a="Cloud")
    assert got[:2] == ["cloud", "cloud services"] and len(got) == len(set(got))
