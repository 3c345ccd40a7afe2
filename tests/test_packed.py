from loomtab.operators.packed import names_with_delimiters, split_packed

SCHEMA = "row_id bigint, names string, field_name string, cell string"

TAUGHT = ["Old Anvil", "Red Heron", "KV/L-64", "Project 12", "Storm Otter", "TS/B-3; Old Anvil", "Ostra and Merrin; Mirrow", "Mirrow", "Zemlin"] * 5
CASES = {
    'Old Anvil;; Red Heron ; ': ["Old Anvil", "Red Heron"],
    '"Veldak, Mk 3"': ["Veldak, Mk 3"],
    '"Veldak, Mk 3", Red Heron': ["Veldak, Mk 3", "Red Heron"],
    '"Red Kestrel ""Sarne"""; "Old Anvil ""Kartal"""': ['Red Kestrel "Sarne"', 'Old Anvil "Kartal"'],
    "(1) Old Heron (2) Red Anvil, Mk 2": ["Old Heron", "Red Anvil, Mk 2"],
    "1. Old Heron 2. TS/B-3": ["Old Heron", "TS/B-3"],
    "KV/L-64": ["KV/L-64"],
    "Zemlin/Mirrow": ["Zemlin", "Mirrow"],
    "Old Anvil, Red Heron, and Storm Otter": ["Old Anvil", "Red Heron", "Storm Otter"],
    "Old Anvil & Red Heron": ["Old Anvil", "Red Heron"],
    "Ostra and Merrin": ["Ostra and Merrin"],
    "Mirrow and Ostra and Merrin": ["Mirrow", "Ostra and Merrin"],
    "Zemlin (engines, radar) / Mirrow": ["Zemlin (engines, radar)", "Mirrow"],
    "Zemlin; Mirrow\nZemlin | Mirrow<br>Zemlin": ["Zemlin", "Mirrow", "Zemlin", "Mirrow", "Zemlin"],
    "August 9, 1991": ["August 9, 1991"],
    "August 9, 1991, 1998/99": ["August 9, 1991", "1998/99"],
    "2011–2018 / c. 1999": ["2011–2018", "c. 1999"],
    "«Zemlin», “Mirrow”": ["Zemlin", "Mirrow"],
}


def parts(spark, cells, guards=("Ostra and Merrin",)):
    rows = [(i, c, "clash", "clash") for i, c in enumerate([*TAUGHT, *cells])]
    got = split_packed(spark.createDataFrame(rows, SCHEMA), ["names"], guards).orderBy("row_id", "item_pos").collect()
    out = {}
    for r in got:
        out.setdefault(r["row_id"], []).append(r["item_value"])
        assert r["item_pos"] == len(out[r["row_id"]])
    return [out.get(i, []) for i in range(len(TAUGHT), len(rows))]


def test_cells(spark):
    assert dict(zip(CASES, parts(spark, CASES))) == CASES


def test_odd_cells(spark):
    cells = [None, "", "   ", ";;;", '"never closed; Old Anvil', '""', "Old Anvil; Old Anvil"]
    got = parts(spark, cells)
    # signs alone are one value as they stand; only nothing at all is none
    assert got[:4] == [[], [], [], [";;;"]] and got[5] == [] and got[6] == ["Old Anvil", "Old Anvil"]
    assert got[4] == ['"never closed', "Old Anvil"]


def test_very_long_cells(spark):
    many = "; ".join(f"Item {i}" for i in range(30_000))
    got = parts(spark, [many, "a " * 150_000, " " * 300_000 + "x", "(" * 100_000, '"' * 100_001])
    assert len(got[0]) == 30_000 and got[0][-1] == "Item 29999"
    assert len(got[1]) == 1 and got[2] == ["x"]


def test_empty_table(spark):
    assert split_packed(spark.createDataFrame([], SCHEMA), ["names"]).count() == 0


def test_names_with_delimiters(spark):
    df = spark.createDataFrame([("Ostra and Merrin",), ("L'Orme",), (None,), ("A, B",)], "country string")
    assert names_with_delimiters(df) == ["A, B", "Ostra and Merrin"]


def test_values_joined_by_or(spark):
    cases = {
        "Zemlin or Mirrow": ["Zemlin", "Mirrow"],
        "Mirrow or Mirrow": ["Mirrow", "Mirrow"],
        "«Zemlin» or “Mirrow Yards, Zemlin”": ["Zemlin", "Mirrow Yards, Zemlin"],
        "Zemlin (kits or parts) or Mirrow": ["Zemlin (kits or parts)", "Mirrow"],
        "Zemlin, Mirrow, or Ostra and Merrin": ["Zemlin", "Mirrow", "Ostra and Merrin"],
        "Ostra or Merrin": ["Ostra or Merrin"],
    }
    assert dict(zip(cases, parts(spark, cases, ("Ostra and Merrin", "Ostra or Merrin")))) == cases


def test_long_writing_patterns_differ_to_their_end(spark):
    from loomtab.operators.packed import value_shape

    rows = [("long", "Ab-1/" * 20 + "end"), ("same", "Cd-27/" * 20 + "other"), ("other", "Ab-1/" * 20 + "9"), ("short", "Old Anvil, Mk 3")]
    got = {r["k"]: r["s"] for r in spark.createDataFrame(rows, "k string, v string").select("k", value_shape("v").alias("s")).collect()}
    assert got["long"] == got["same"] != got["other"] and got["short"] == "a, a 9"


def test_quotes_may_be_letters(spark):
    cases = {
        '6" barrel; 8" barrel; x': ['6" barrel', '8" barrel', "x"],
        '12" gun, 14" gun': ['12" gun', '14" gun'],
        '"Old Anvil, Mk 3"; "Red Heron"': ["Old Anvil, Mk 3", "Red Heron"],
        'Red "Sarne, Mk 2" Heron, Old Anvil': ['Red "Sarne, Mk 2" Heron', "Old Anvil"],
    }
    taught = ['5" gun', '7" gun', "Red Heron"] * 3
    assert dict(zip(cases, parts(spark, [*cases, *taught]))) == cases


def test_more_than_a_thousand_names_with_delimiters(spark):
    import random
    import re

    from loomtab.operators.packed import guard_names

    rng = random.Random(5)
    names = sorted({"".join(rng.choice("abcdegh") for _ in range(rng.randint(2, 6))).title() + rng.choice([" and ", ", ", "/"]) + rng.choice(["Sund", "Sunda", "Merrin"]) for _ in range(3000)})
    assert len(names) > 1000
    df = spark.createDataFrame([(n,) for n in names], "country string")
    assert names_with_delimiters(df) == names
    pattern = re.compile(guard_names(names).replace(r"\p{L}", "[A-Za-z]"))
    assert all(pattern.fullmatch(n) for n in names) and not pattern.fullmatch("Zz and Sund") and guard_names([]) == ""
    got = parts(spark, [f"{names[7]}, {names[1200]}", f"Zemlin; {names[-1]}"], names)
    assert got == [[names[7], names[1200]], ["Zemlin", names[-1]]]
