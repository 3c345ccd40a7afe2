import pytest
from pyspark.sql import functions as F

from loomtab.functions import quantity as Q
from loomtab.functions import text as X


def one(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_normalize_text(spark):
    got = one(spark, X.normalize_text, [" A B c ", "ﬁ​ne­ly", "a\tb\nc", "ＸＹ", None, "", "  "])
    assert got == ["a b c", "finely", "abc", "xy", None, "", ""]


def test_slug_singular_and_integers(spark):
    assert one(spark, X.clean_name, [" Côte d'Ivoire ", "__a--b__", "", None]) == ["c_te_d_ivoire", "a_b", "", None]
    assert one(spark, X.singularize, ["tanks", "class", "s", "", None]) == ["tank", "class", "", "", None]
    assert one(spark, X.safe_int, ['13"', "2[a]", "4†", None, "x", "9" * 30]) == [13, 2, 4, 1, 1, 1]
    assert one(spark, X.zero_pad, [3, 12, 123], "int") == ["03", "12", "123"]


def test_is_quantity(spark):
    values = ["7", "Frigates (5)", "active (3)", "Frigates (5 + 1)", "Tanks", "total (4) boats"]
    assert one(spark, X.is_quantity, values) == [True, True, True, False, False, True]


def test_clean_html(spark):
    values = ["a[3] b[note 4] c[citation needed]", "x<sup class='r'>1</sup>y<!-- gone -->  z", '<span class="mw-editsection">[edit]</span>t', None]
    assert one(spark, X.clean_html, values) == ["a b c[citation needed]", "xy z", "t", None]


def test_titles_keys_and_prefixes(spark):
    df = spark.createDataFrame([("A", None, "C"), ("", "", None)], "a string, b string, c string")
    assert [r[0] for r in df.select(X.section_title(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["A_C", "untitled"]
    df = spark.createDataFrame([("Korea  North Tanks", "korea north"), ("Tanks", "x"), (None, "x")], "c string, k string")
    assert [r[0] for r in df.select(X.strip_country_prefix(F.col("c"), F.col("k"))).collect()] == ["tanks", "tanks", None]
    assert one(spark, X.country_of_key, ["abc_table_01_x", "abc", None]) == ["abc", "", None]
    assert one(spark, X.escape_literal, ["it's", None]) == ["it''s", ""]


QUANTITIES = [
    ("12", None, 12), ("5 + 12", None, 5), ("12 (1998)", None, 12), ("1998", None, 1998), ("", None, None), ("none", None, None), (None, None, None),
    ("12.0", None, 0), ("1,003", None, 1), ("3 (2)", "Vessel", 2), ("3 4", "Vessel", 1), ("7", "A, B", 1), ("", "A, B", None), ("9" * 40, None, None),
    ("8", "USS a USS b", 1), ("8", "One Two Three", 1), ("8", "(a) (b)", 1), ("8", "", 8),
]


def test_quantities(spark):
    df = spark.createDataFrame([(i, q, s) for i, (q, s, _) in enumerate(QUANTITIES)], "i int, quantity string, ship_name string")
    got = [r["quantity_clean"] for r in Q.with_clean_quantity(df).orderBy("i").collect()]
    assert got == [want for *_, want in QUANTITIES]


@pytest.mark.parametrize("n", [200_000])
def test_very_long_text(spark, n):
    got = one(spark, X.tidy_text, [" " * n + "a" + " " * n + "b" + " " * n])
    assert got == ["a b"]
