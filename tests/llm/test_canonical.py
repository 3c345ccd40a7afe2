from loomtab.llm.canonical import map_to_reference, reference_names

NODES = [
    (1, "Inventory", None), (2, "Naval craft", None), (3, "Torpedo boat", None), (4, "Search radar", None), (5, "Main battle tank", "MBT"),
    (6, "Strike drone", "combat UAV; UCAV"), (7, "Recoilless gun", None), (8, "Transport aircraft", None), (9, "Light mortar", None),
    (10, "Combat knife", "fighting blade"), (11, "Body armour", "flak vest"), (12, "Armoured car", None), (13, "Heavy mortar", None),
    (14, "Command vehicle", None), (15, "Midget submarine", "mini-sub"), (16, "Submachine gun", "SMG"),
]
CASES = {
    "Naval craft": 2, "NAVAL_CRAFT *": 2, "3.1 Navvalecraft": 2, "Craft, naval": 2, "craft - naval": 2, "Craft (naval) [3]": 2,
    "Ｎａｖａｌ ｃｒａｆｔ （６４）": 2, "navalcraft": 2, "Active naval craft since 1980": 2, "Table 4: Torpedo boats": 3, "toredo oat": 3,
    "MBTs": 5, "UCAV": 6, "combat UAVs – in service": 6, "GUNS (RECOILLESS)": 7, "transp. a/c": 8, "tpt acft": 8, "Lt. mortar": 9, "hvy mortar": 13,
    "Combat knives": 10, "body armor (current)": 11, "• Armd. car": 12, "command vhcl": 14, "midget sub": 15, "The SMG": 16,
    "Torpedo nets": 0, "Search teams": 0, "Gallery": 0, "Modern inventory (1971)": 0, "???": 0, "Mortar": 0, "xxx": 0, "x" * 50_000: 0, "." * 100_000 + "x": 0,
}


def mapped(spark, values, nodes=NODES, **kw):
    reference = reference_names(spark.createDataFrame(nodes, "node_id int, name string, other_names string"))
    got = map_to_reference(spark.createDataFrame([(v, "clash") for v in values], "value string, text string"), reference, **kw)
    return {r["value"]: r["node_id"] for r in got.collect()}


def test_headings(spark):
    assert mapped(spark, CASES) == CASES


def test_nulls_blanks_and_repeats(spark):
    assert mapped(spark, [None, "", "  ", "​", "Naval craft", "Naval craft"]) == {"Naval craft": 2}


def test_ties_name_none_and_empty_tables(spark):
    tied = [(1, "Red boat", None), (2, "Rid boat", None)]
    assert mapped(spark, ["Rxd boat", "Rid boat"], tied) == {"Rxd boat": 0, "Rid boat": 2}
    assert mapped(spark, ["a"], []) == {"a": 0}
    assert mapped(spark, []) == {}


def test_any_number_of_decorations(spark):
    cases = {
        "SMG [1][2][3][4]": 16, "SMG [1] (2) [3] * (4) [5]; (current) [6] – in service [7]": 16, "1. (2) 3) 4. 5. SMG": 16, "the active the active list of SMG": 16,
        "Naval craft" + " [9]" * 3_000: 2, "[1]" * 30_000 + "x": 0, "SMG [1][2][3][4] x": 0,
    }
    assert mapped(spark, cases) == cases


def test_cosine_rejects_words_that_are_only_near_in_letters(spark):
    assert mapped(spark, ["Combat pay", "combat UAV", "combat uav's"]) == {"Combat pay": 0, "combat UAV": 6, "combat uav's": 6}


def test_many_abbreviations_make_no_product(spark):
    longs = [(100 + i, f"{a} {b} station system", None) for i, (a, b) in enumerate((f"m{x}r{y}tion", f"s{y}r{x}ling") for x in "aeiou" for y in "aeiou")]
    got = mapped(spark, ["mr st mt st sr ms", "maration sarling stn sys"], [*NODES, *longs])
    assert got["maration sarling stn sys"] == 100
