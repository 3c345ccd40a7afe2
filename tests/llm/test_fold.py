import unicodedata

from pyspark.sql import functions as F

from loomtab.llm import fold


def one(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_folding(spark):
    e = unicodedata.normalize("NFD", "É-1")
    assert len(set(one(spark, fold.letters_and_digits, ["É-1", e, " é 1 "]))) == 1
    assert one(spark, fold.strip_accents, ["Dreporé Ñandú", "x"]) == ["Drepore Nandu", "x"]
    assert one(spark, fold.halfwidth, ["Ｔａｂｌｅ　６：", None]) == ["Table 6:", None]


def test_decompose_equals_unicode(spark):
    texts = [chr(i) + "x" for a, b in fold._RANGES for i in range(a, b + 1)] + ["plain", "", "日本"]
    assert one(spark, fold.decompose, texts) == [unicodedata.normalize("NFD", t) for t in texts]
