import random

import pytest
from pyspark.sql import functions as F

from loomtab.operators import cleaning as C
from loomtab.schemas import RAW_ROWS


def table(name, names, *rows):
    return [(name, i, [(p, n, v) for p, (n, v) in enumerate(zip(names, row))]) for i, row in enumerate(rows)]


def frame(spark, *tables):
    return spark.createDataFrame([r for t in tables for r in t], RAW_ROWS)


def read(df):
    out = {}
    for r in df.orderBy("table_name", "row_idx").collect():
        out.setdefault(r["table_name"], []).append([(c["name"], c["value"]) for c in r["cells"]])
    return out


def test_row_kinds(spark):
    df = frame(spark, table("t", "ab", ("", None), ("x", "x"), ("Frigates (5)", "Frigates (5)"), ("7", "7"), ("a", "b"), (" y", "y ")), [("e", 0, [])])
    got = [r[0] for r in df.orderBy(F.desc("table_name"), "row_idx").select(C.row_kind(F.col("cells"))).collect()]
    assert got == ["empty", "section", "quantity", "quantity", "data", "section", "empty"]


def forward_fill(rows):
    out, told, has_s, has_q = [], (None, None), False, False
    import re

    kinds = []
    for row in rows:
        vals = {(v or "").strip() for v in row}
        kinds.append("data" if len(vals) > 1 else "empty" if vals == {""} else "meta")
    has_s = "meta" in kinds
    has_q = any(k == "meta" and re.search(r"^\d+$|\(\d+\)$", (row[0] or "").strip()) for k, row in zip(kinds, rows))
    for k, row in zip(kinds, rows):
        if k == "meta":
            text = (row[0] or "").strip()
            m = re.search(r"\(\d+\)", text)
            told = (re.sub(r"\(\d+\)", "", text).strip(), m.group() if m else None)
        elif k == "data":
            out.append((told[0] if has_s else None, told[1] if has_q else None))
    return out


@pytest.mark.parametrize("block", [100_000, 2])
def test_forward_fill_equals_a_loop(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rng = random.Random(1)
    tables, want = [], {}
    for t in range(6):
        rows = []
        for _ in range(rng.randint(3, 12)):
            v = rng.choice(["", "Ships", "Ships (4)", "9", None])
            rows.append((v, v) if rng.random() < 0.5 else (f"a{len(rows)}", "b"))
        tables.append(table(f"t{t}", "ab", *rows))
        want[f"t{t}"] = forward_fill(rows)
    got = {}
    for r in C.propagate_sections(frame(spark, *tables)).orderBy("table_name", "row_idx").collect():
        got.setdefault(r["table_name"], []).append((r["section"], r["quantity"]))
        assert r["row_idx"] == len(got[r["table_name"]]) - 1
    assert got == {k: v for k, v in want.items() if v}


def test_doublewide(spark):
    wide = table("w", ["a", "b", "a.1", "b.1"], ("1", "2", "3", "4"), ("5", "6", None, None))
    odd = table("o", ["a", "b", "a.1"], ("1", "2", "3"))
    other = table("x", ["a", "b", "c", "d"], ("1", "2", "3", "4"))
    got = read(C.split_doublewide(frame(spark, wide, odd, other)))
    assert got["w"] == [[("a", "1"), ("b", "2")], [("a", "5"), ("b", "6")], [("a", "3"), ("b", "4")]]
    assert len(got["o"][0]) == 3 and len(got["x"][0]) == 4
    staggered = read(C.split_doublewide(frame(spark, wide), positional=False))["w"]
    assert staggered[2] == [("a.1", "3"), ("b.1", "4")]


def test_multi_level_headers(spark):
    names = ["('Arms', 'Name')", "('Arms', 'Origin')", "('Arms', 'Unnamed: 2')"]
    got = read(C.standardize_names(frame(spark, table("t", names, ("x", "y", "z")))))["t"]
    assert got == [[("name", "arms"), ("origin", "arms")], [("name", "x"), ("origin", "y")]]
    same = read(C.standardize_names(frame(spark, table("t", ["('A', 'B')", "('A', 'B')"], ("x", "y")))))["t"]
    assert [n for n, _ in same[1]] == ["a", "a_2"]
    assert read(C.standardize_names(frame(spark, table("t", [" Name ", "7"], ("x", "y")))))["t"] == [[("name", "x"), ("7", "y")]]


def test_make_unique(spark):
    df = spark.createDataFrame([(["a", "b", "a", "a"],), ([],)], "n array<string>")
    assert [r[0] for r in df.select(C.make_unique(F.col("n"))).collect()] == [["a", "b", "a_2", "a_3"], []]


def test_clean_all(spark):
    good = table("g", ["Name", "Photo", "3", "Unnamed: 3", "quantity"], ("Tanks (5)",) * 5, ("T1", "p", "n", "u", "old"), ("",) * 5)
    bad = table("b", ["1", "Unnamed: 1"], ("x", "y"))
    only_sections = table("s", ["a", "b"], ("x", "x"))
    got = read(C.clean_all(frame(spark, good, bad, only_sections)))
    assert got == {"g": [[("section", "Tanks"), ("quantity", "(5)"), ("name", "T1")]]}
    assert C.clean_all(frame(spark, [])).count() == 0


def test_column_lists(spark):
    df = frame(spark, table("t", ["a", "", "null", "c"], ("1", "2", "3", "4")))
    cols = C.column_list(df)
    assert sorted((r["column_name"], r["pos"]) for r in cols.collect()) == [("a", 0), ("c", 3)]
    assert C.wide_columns(cols, ["a", "c"]).first().asDict() == {"table_name": "t", "a": "a", "c": "c"}


def test_compose_names(spark):
    got = read(C.compose_names(frame(spark, table("t", ["ﬁeld", None, "Ｑ"], ("ﬁ", None, "x")))))
    assert got == {"t": [[("field", "ﬁ"), (None, None), ("Q", "x")]]}
