import functools
import random

import pytest
from pyspark.sql import functions as F

from loomtab.operators import classification, legacy, mapping, refine, summary, taxonomy
from loomtab.schemas import CANONICAL_COLUMNS

NODES = [
    ("Equipment", "class", None), ("Vessel", "class", "Equipment"), ("Warship", "class", "Vessel"), ("Frigate", "class", "Warship"), ("Destroyer", "class", "Warship"),
    ("Aircraft", "class", "Equipment"), ("EquipMission", "class", None), ("Role", "class", "EquipMission"), ("Training", "class", "Role"),
    ("Relationship", "class", "EquipMission"), ("Platform", "class", "Relationship"), ("Country", "class", None), ("Navy", "class", "Country"), ("Lost", "class", "Nowhere"),
    ("LoopA", "class", "LoopB"), ("LoopB", "class", "LoopA"), ("Frigate", "class", "Warship"),
]
RULES = [
    ("Vessel", "class", r"vessel|\bship", None), ("Warship", "class", "warship", None), ("Frigate", "class", "frigate", None), ("Destroyer", "class", "destroyer", None), ("Aircraft", "class", "aircraft", None),
    ("Training", "class", "training", None), ("Platform", "class", "platform", None), ("Navy", "class", "navy", None), ("HasDate", "data property", "^year$|date", "dates"),
    ("IsType", "data property", "system|class", "equip_type"), ("IsVariant", "data property", "variant|version class", "variant"),
]


@pytest.fixture(scope="module")
def tax(spark):
    nodes = spark.createDataFrame(NODES, "name string, kind string, parent string")
    rules = spark.createDataFrame(RULES, "entity string, kind string, pattern string, super_col string")
    return nodes, rules, taxonomy.paths(nodes)


def test_paths(tax):
    got = {r["name"]: (r["root"], r["depth"], ">".join(r["path"])) for r in tax[2].collect()}
    assert got["Frigate"] == ("Equipment", 3, "Equipment>Vessel>Warship>Frigate")
    assert not {"Lost", "LoopA", "LoopB"} & set(got)
    with pytest.raises(ValueError):
        taxonomy.paths(tax[0], max_nodes=3)


def test_common_ancestors(spark):
    rows = [([["A", "B", "C"], ["A", "B", "D"]],), ([["A", "B"], ["A", "B", "D"]],), ([["A"], ["X"]],), ([["A", "B"]],), ([],)]
    df = spark.createDataFrame(rows, "p array<array<string>>")
    assert [r[0] for r in df.select(taxonomy.nearest_common_ancestor(F.col("p"))).collect()] == ["B", "B", None, "B", None]
    assert [len(r[0]) for r in df.select(taxonomy.leafmost(F.col("p"))).collect()] == [2, 1, 2, 1, 0]
    assert df.select(taxonomy.ancestor(F.element_at("p", 1), 1)).first()[0] == "B"


def test_match_rules(spark, tax):
    texts = spark.createDataFrame([("Training SHIPS",), ("Training SHIPS",), ("none",), (None,)], "text string")
    got = {(r["text"], r["entity"]) for r in taxonomy.match_rules(texts, tax[1]).collect()}
    assert got == {("Training SHIPS", "Training"), ("Training SHIPS", "Vessel")}
    assert taxonomy.match_rules(texts, tax[1].limit(0)).count() == 0
    raw = spark.createDataFrame([("A", "class", ["REGEX:x", " y", ""], None)], "entity string, kind string, patterns array<string>, super_col string")
    assert [r["pattern"] for r in taxonomy.rules_of(raw).collect()] == ["x", "y"]


TABLES = [
    ("one", "Navy frigates", None, None), ("two", "Frigate", "Warship list", ""), ("mission", "Training", None, "Aircraft"), ("none", None, "", None), ("prof", "Fleet", None, None),
]


def classified(spark, tax, collapse="none"):
    tables = spark.createDataFrame(TABLES, "table_name string, section_h2 string, section_h3 string, section_h4 string")
    texts = tables.select(F.explode(F.array("section_h2", "section_h3", "section_h4")).alias("text"))
    return classification.classify_by_headings(tables, taxonomy.match_rules(texts, tax[1].where("kind = 'class'")), tax[2], "Equipment", collapse)


def test_classes_by_headings(spark, tax):
    got = {r["table_name"]: r for r in classified(spark, tax).collect()}
    assert (got["one"]["equipment_class"], got["one"]["other_classes"], got["one"]["confidence"]) == ("Frigate", ["Navy"], 1.0)
    assert got["one"]["class_path"] == "Equipment>Vessel>Warship>Frigate"
    assert got["two"]["equipment_class"] is None and got["two"]["other_classes"] == ["Frigate", "Warship"]
    assert got["mission"]["equipment_class"] == "Aircraft" and got["mission"]["leaf_header"] == "Aircraft"
    assert got["none"]["confidence"] == 0.0 and got["none"]["other_classes"] == [] and got["none"]["leaf_header"] is None
    leaf = {r["table_name"]: r["equipment_class"] for r in classified(spark, tax, "leaf").collect()}
    assert leaf["two"] == "Frigate"


def test_classes_by_profile(spark, tax):
    columns = spark.createDataFrame([("one", "hull", 0), ("one", "guns", 1), ("prof", "hull", 0), ("prof", "guns", 1), ("none", "zzz", 0)], "table_name string, column_name string, pos int")
    c = classified(spark, tax)
    features = classification.table_features(c, columns, tax[0], tax[1])
    out = classification.classify_by_profile(c, features, classification.starter_groups(tax[0], tax[2], rules=tax[1]))
    got = {r["table_name"]: (r["equipment_class"], r["confidence"]) for r in out.collect()}
    assert got["one"] == ("Frigate", 1.0) and got["prof"][0] == "Frigate" and 0.2 < got["prof"][1] < 1
    assert got["none"] == (None, 0.0)
    assert {r["table_name"] for r in classification.unclassified(out).collect()} >= {"none"}
    order = spark.createDataFrame([("one", 0), ("two", 1), ("prof", 2)], "table_name string, seq int")
    groups = classification.starter_groups(tax[0], tax[2], rules=tax[1])
    single = classification.classify_one_by_one(c, features, groups, order)
    got = {r["table_name"]: (r["equipment_class"], r["confidence"]) for r in single.collect()}
    assert got["one"] == ("Frigate", 1.0) and got["prof"][0] == "Frigate" and got["none"] == (None, 0.0)
    assert single.columns == out.columns
    with pytest.raises(ValueError):
        classification.classify_one_by_one(c, features, groups, order, max_features=2)


def test_classes_in_order_are_those_of_one_by_one(spark, tax):
    rng = random.Random(5)
    names = [f"t{i:03d}" for i in range(300)]
    rows = [(t, rng.choice(("classes", "raw_cols", "parent")), f"f{min(rng.randrange(40), rng.randrange(40))}") for t in names for _ in range(rng.randrange(1, 9))]
    rows += [("unknown", "raw_cols", "f1"), ("alone", "raw_cols", "nowhere else")]
    features = spark.createDataFrame(rows, "table_name string, kind string, feature string").distinct()
    groups = spark.createDataFrame([(f"g{i}", k, f"f{(i * 7 + j) % 40}") for i in range(12) for j, k in enumerate(("classes", "parent", "children"))], "grp string, kind string, feature string")
    own = {t: rng.choice(["g1", "g5", "new"]) for t in names[::4]}
    c = spark.createDataFrame([(t, own.get(t), [], float(t in own)) for t in [*names, "alone", "bare"]], "table_name string, equipment_class string, other_classes array<string>, confidence double")
    order = spark.createDataFrame([(t, i, i % 7) for i, t in enumerate(rng.sample(names, 250))], "table_name string, a int, b int").select("table_name", F.struct("b", "a").alias("seq"))
    want = classification.classify_one_by_one(c, features, groups, order)
    got = classification.classify_in_order(c, features, groups, order)
    assert got.columns == want.columns
    got, want = ({r["table_name"]: (r["equipment_class"], round(r["confidence"], 9)) for r in df.collect()} for df in (got, want))
    assert got == want and got["alone"] == got["bare"] == (None, 0.0)
    assert len({k for k, _ in got.values()}) > 8 and sum(0 < s < 1 for _, s in got.values()) > 50


def test_order_decides_and_ties_go_to_the_first_name(spark):
    c = spark.createDataFrame([(i, None, [], 0.0) for i in (1, 2, 3)], "id bigint, equipment_class string, other_classes array<string>, confidence double")
    features = spark.createDataFrame([(1, "c", "x"), (1, "c", "y"), (2, "c", "y"), (2, "c", "z"), (3, "c", "q")], "id bigint, kind string, feature string")
    # b holds q in three kinds and has norm 18, h in one and has norm 2: equally near to q
    far = [("b", k, f) for f, n in (("q", 3), ("r", 3)) for k in "cde"[:n]]
    groups = spark.createDataFrame([("d", "c", "x"), ("e", "c", "z"), ("e", "c", "v"), ("e", "c", "w"), ("h", "c", "q"), ("h", "c", "s"), *far], "grp string, kind string, feature string")
    for seqs, two in (((1, 2), "d"), ((2, 1), "e")):
        order = spark.createDataFrame(list(zip((1, 2), seqs)), "id bigint, seq int")
        got = {r["id"]: r["equipment_class"] for r in classification.classify_in_order(c, features, groups, order, cuts=(0.3,), key="id").collect()}
        assert got == {1: "d", 2: two, 3: "b"}


def test_the_query_in_order_takes_more_than_the_driver(spark, sf_dir, monkeypatch):
    import __spark_entry__ as entry
    from loomtab.plans.reference_queries import _features, read_table

    c, features, groups = _features(spark, sf_dir)
    order = read_table(spark, sf_dir, "a_meta_table").select("meta_id", F.col("meta_id").alias("seq"))
    want = classification.classify_one_by_one(c, features, groups, order, key="meta_id").select("meta_id", "equipment_class", F.round("confidence", 6)).collect()
    monkeypatch.setattr(classification, "classify_one_by_one", functools.partial(classification.classify_one_by_one, max_features=2))
    got = entry.queries()["table_profiles_in_order"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 40


def test_cosine(spark):
    t = spark.createDataFrame([("t", "classes", "a"), ("t", "raw_cols", "b"), ("u", "raw_cols", "z")], "table_name string, kind string, feature string")
    g = spark.createDataFrame([("g", "classes", "a"), ("g", "parent", "a"), ("g", "raw_cols", "c"), ("h", "classes", "a")], "grp string, kind string, feature string")
    got = {(r["table_name"], r["grp"]): round(r["score"], 6) for r in classification.profile_cosine(t, g).collect()}
    assert got == {("t", "g"): round(2 / (2**0.5 * 5**0.5), 6), ("t", "h"): round(1 / 2**0.5, 6)}
    tied = spark.createDataFrame([("t", "b", 0.5), ("t", "a", 0.5), ("t", "c", 0.4)], "table_name string, grp string, score double")
    assert classification.best_group(tied).first()["grp"] == "a"


def test_column_classes(spark):
    cols = [
        ("a", "section", 0), ("a", "quantity", 1), ("a", "year", 2), ("a", "model", 3), ("a", "name", 4), ("a", "junk", 5), ("a", "both", 6),
        ("b", "nick", 0), ("b", "junk", 1), ("c", "kind", 0), ("c", "name", 1), ("d", "mark", 0),
    ]
    hits = [("year", "dates"), ("nick", "other_names"), ("kind", "equip_type"), ("mark", "variant"), ("both", "dates"), ("both", "equip_type"), ("quantity", "quantity"), ("quantity", "status")]
    got = mapping.classify_columns(spark.createDataFrame(cols, "table_name string, column_name string, pos int"), spark.createDataFrame(hits, "text string, super_col string"))
    assert {(r["table_name"], r["raw_col"]): r["super_col"] for r in got.collect()} == {
        ("a", "section"): "sub_class", ("a", "quantity"): "quantity", ("a", "year"): "dates", ("a", "model"): "equip_type", ("a", "name"): "note",
        ("a", "junk"): "note", ("a", "both"): "note", ("b", "nick"): "equip_type", ("b", "junk"): "note", ("c", "kind"): "equip_type", ("c", "name"): "note", ("d", "mark"): "equip_type",
    }


def test_master_propagates_nulls(spark):
    rows = spark.createDataFrame(
        [("t", 0, [(0, "s", "Tank"), (1, "n", "A"), (2, "m", "B")]), ("t", 1, [(0, "s", None), (1, "n", "C"), (2, "m", None)]), ("u", 0, [])],
        "table_name string, row_idx int, cells array<struct<pos:int,name:string,value:string>>",
    )
    maps = spark.createDataFrame([("t", "s", "sub_class", 0), ("t", "n", "note", 1), ("t", "m", "note", 2)], "table_name string, raw_col string, super_col string, ord int")
    heads = spark.createDataFrame([("t", "u1", "Land", None, "Vehicle"), ("u", "u2", "Land", "A>B", None)], "table_name string, url string, country string, class_path string, sub_class string")
    got = {(r["table_name"], r["row_idx"]): r for r in mapping.build_master(rows, maps, heads).collect()}
    assert got["t", 0]["sub_class"] == "Vehicle; Tank" and got["t", 0]["note"] == "A; B" and got["t", 0]["country"] == "Land"
    assert got["t", 1]["sub_class"] is None and got["t", 1]["note"] is None and got["t", 1]["origin"] is None
    assert got["u", 0]["class_path"] == "A>B" and got["u", 0]["sub_class"] is None and got["u", 0]["url"] == "u2"


REPAIR = [
    ("Frigates; Destroyer", None, None), ("Frigates", None, "old"), ("Training frigates", "old role", None), ("Warship; Frigate", None, None), ("Frigate; Aircraft", None, None),
    ("Zork", None, "keep"), ("Navy", None, "keep"), (None, None, "keep"), ("", None, "keep"), ("Platform; Frigate", None, None), ("Frigate; Zork", None, None),
]


def repaired(spark, tax, **kw):
    rows = [(i, *[{"sub_class": s, "role": role, "note": note, "class_path": "p"}.get(c) for c in CANONICAL_COLUMNS], "clash") for i, (s, role, note) in enumerate(REPAIR)]
    df = spark.createDataFrame(rows, "row_id int, " + ", ".join(f"{c} string" for c in CANONICAL_COLUMNS) + ", contestant string")
    fixed = refine.fix_classes(df, tax[1], tax[2], CANONICAL_COLUMNS, **kw)
    return fixed, {r["row_id"]: r for r in fixed.collect()}


def test_class_repair(spark, tax):
    fixed, got = repaired(spark, tax)
    seen = [(got[i]["sub_class"], got[i]["class_path"], got[i]["role"], got[i]["note"]) for i in range(len(REPAIR))]
    frigate = "Equipment>Vessel>Warship>Frigate"
    assert seen == [
        ("Warship", "Equipment>Vessel>Warship", None, "Destroyer; Frigate"),
        ("Frigate", frigate, None, "old"),
        ("Frigate", frigate, "Training", "Training frigate"),
        ("Warship", "Equipment>Vessel>Warship", None, "Frigate"),
        ("Equipment", "Equipment", None, "Aircraft; Frigate"),
        (None, "p", None, "Zork"),
        (None, "p", None, "keep"),
        (None, "p", None, "keep"),
        ("", "p", None, "keep"),
        ("Frigate", frigate, None, "Platform"),
        ("Frigate", frigate, None, "Zork"),
    ]
    assert {r["contestant"] for r in refine.unknown_contestants(fixed).collect()} == {"Zork"}


def test_leaf_collapse(spark, tax):
    _, got = repaired(spark, tax, collapse="leaf")
    assert got[3]["sub_class"] == "Frigate" and got[0]["sub_class"] == "Warship"


def test_summary_and_views(spark):
    rows = spark.createDataFrame(
        [("A", "E>V", None, 3), ("A", "E>V", None, 4), ("A", "E", "Equipment", 9), ("B", "E>V", "Boat", None), ("B", None, "Boat", 5), ("B", "E>V", "Boat", 2), ("B", "E>T", "Tank", 1)],
        "country string, class_path string, sub_class string, quantity_clean bigint",
    )
    got = {tuple(r) for r in summary.summarise(rows).collect()}
    assert got == {("A", "E>V", None, 7), ("B", "E>V", "Boat", 2), ("B", "E>T", "Tank", 1)}
    bins = {r[0] for r in rows.select(summary.class_bin(F.col("sub_class"))).distinct().collect()}
    assert bins == {None, "Equipment", "Boat, Corvette, Cruiser, Destroyer, Frigate, Submarine, Vessel", "Artillery, Tank, Vehicle"}
    assert summary.include_members(rows, "sub_class", [None, "Tank"]).count() == 3
    assert summary.exclude_pairs(rows, [("B", "Boat")], ("country", "sub_class")).count() == 4
    cross = {r["country"]: (r["Boat"], r["Tank"]) for r in summary.crosstab(rows, "country", "sub_class", "quantity_clean", ["Boat", "Tank"]).collect()}
    assert cross == {"A": (None, None), "B": (7, 1)}


def test_older_groupings(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "a array<string>, b array<string>")
    assert [round(r[0], 6) for r in df.select(legacy.jaccard(F.col("a"), F.col("b"))).collect()] == [0.333333, 0.0]
    members = spark.createDataFrame([("c", "x"), ("c", "x"), ("c", "y"), ("c", None), ("d", None)], "cluster string, leaf_header string")
    got = {r["cluster"]: (r["label"], r["strength"], r["size"]) for r in legacy.label_and_strength(members).collect()}
    assert got == {"c": ("x", 0.5, 4), "d": (None, 0.0, 1)}
    profile = "struct<header:array<string>,parent:array<string>,category:array<string>,column:array<string>>"
    p = (["h"], ["p"], ["c"], ["a", "b"])
    tables = spark.createDataFrame([("c", p), ("z", p)], f"cluster string, profile {profile}")
    reps = spark.createDataFrame([("c", (["h"], ["q"], ["c"], ["a"]))], f"cluster string, profile {profile}")
    got = {r["cluster"]: round(r["confidence"], 6) for r in legacy.confidence_to_representative(tables, reps).collect()}
    assert got == {"c": 0.85, "z": 0.0}


def test_greedy_clusters(spark):
    def profile(h, c, cols=()):
        return ([h], [], list(c), list(cols))

    rows = [
        ("a", 0, profile("tank", "x")), ("b", 1, profile("tank", "x", ["q"])), ("c", 2, profile("ship", "y")), ("d", 3, profile("ship", "xyz")),
        ("e", 4, profile("gun", "z")), ("f", 5, (None, None, None, None)),
    ]
    schema = "table_name string, seq int, profile struct<header:array<string>,parent:array<string>,category:array<string>,column:array<string>>"
    df = spark.createDataFrame(rows, schema)
    got = {r["table_name"]: (r["cluster"], r["is_seed"]) for r in legacy.greedy_clusters(df).collect()}
    assert got == {"a": ("a", True), "b": ("a", False), "c": ("c", True), "d": ("c", False), "e": ("e", True), "f": ("f", True)}
    with pytest.raises(ValueError):
        legacy.greedy_clusters(df, max_tables=2)
    assert legacy.greedy_clusters(df.limit(0)).count() == 0


def test_heading_names(spark):
    df = spark.createDataFrame([("Naval Ships", "Old tanks", "Guns"), (None, "Tanks", "Guns"), ("A", "B", None), (None, None, "Guns"), ("", None, None)], "h2 string, h3 string, h4 string")
    leaf, parent = legacy.leaf_and_parent(*map(F.col, ("h2", "h3", "h4")))
    assert [tuple(r) for r in df.select(leaf, parent).collect()] == [("naval_ship", "old_tank"), ("tank", "tank"), ("a", "a"), ("gun", None), (None, None)]


def test_cluster_hierarchy(spark):
    rows = [("tank", "vehicle", 3), ("truck", "vehicle", 1), ("frigate", "ship", 2), ("ship", "sea", 1), ("self", "self", 1), ("p", "q", 1), ("q", "p", 1), ("tank", "land", 1)]
    got = {r["name"]: (r["parent"], r["n_tables"]) for r in legacy.cluster_hierarchy(spark.createDataFrame(rows, "name string, parent string, n_tables bigint")).collect()}
    assert got == {
        "tank": ("vehicle", 4), "truck": ("vehicle", 1), "vehicle": (None, 0), "frigate": ("ship", 2), "ship": (None, 1), "self": (None, 1), "p": (None, 1), "q": ("p", 1),
    }


def test_column_classes_from_all_mappings(spark, tmp_path):
    """Names that only one scrape maps have their rule, whichever scrape it is."""
    import __spark_entry__ as entry
    from loomtab.schemas import MAPPED_FIELDS

    kinds = ", ".join(f"{f} string" for f in MAPPED_FIELDS)
    told = [(i, *[{"speed": f"speed {i}", "dates": f"year {i}"}.get(f) for f in MAPPED_FIELDS]) for i in range(3)]
    spark.createDataFrame(told, f"meta_id bigint, {kinds}").write.parquet(str(tmp_path / "a_mapping_table.parquet"))
    cols = [(7, f"{n} {i}", 2 * i + k) for i in range(3) for k, n in enumerate(("Speed", "Year"))]
    spark.createDataFrame(cols, "meta_id bigint, column_name string, pos int").write.parquet(str(tmp_path / "a_meta_table_of_columns.parquet"))
    got = {r["raw_col"]: r["super_col"] for r in entry.queries()["column_classes_all"](spark, str(tmp_path)).collect()}
    assert got == {f"{n} {i}": c for i in range(3) for n, c in (("speed", "speed"), ("year", "dates"))}
    assert "% 3" not in entry.oracle_sql()["column_classes_all"]


def test_limits_are_in_the_readme():
    import inspect
    from pathlib import Path

    readme = " ".join((Path(__file__).parent.parent / "README.md").read_text().split())
    for f, limit in ((legacy.greedy_clusters, "max_tables"), (legacy.cluster_hierarchy, "max_nodes"), (classification.classify_one_by_one, "max_features")):
        assert f"`{f.__name__}` beyond {inspect.signature(f).parameters[limit].default:,} " in readme


def test_pivot_counts_every_column(spark, tmp_path):
    import __spark_entry__ as entry

    types = ["TEXT", "varchar(20)", "BIGINT", "int64", "Double", "DATE", "odd", "", None]
    spark.createDataFrame([(1, t) for t in types], "meta_id bigint, value_type string").write.parquet(str(tmp_path / "a_meta_table_of_columns.parquet"))
    got = entry.queries()["pivot_type_families"](spark, str(tmp_path)).first().asDict()
    assert got == {"meta_id": 1, "text": 2, "whole number": 2, "real number": 1, "date or time": 1, "unknown": 3}
