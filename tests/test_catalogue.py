"""Readers, lookups, lists and stages that the registered queries only see in one form."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomtab.operators import classification, cleaning, legacy, mapping, taxonomy
from loomtab.plans.pipeline import Compat, Pipeline
from loomtab.sources import files, sinks

CELLS = "table_name string, row_idx int, cells array<struct<pos:int,name:string,value:string>>"


def test_csv_records_keep_line_breaks_and_rows_like_the_header(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text('k,v\nk,v\n"two\nlines, and a comma","say ""x"""\n\n  \nonly\na,b,c\nlast,\n')
    good, bad = files.checked_records(spark, str(f))
    assert sorted((r["fields"]["k"], r["fields"]["v"]) for r in good.collect()) == [("k", "v"), ("last", ""), ("two\nlines, and a comma", 'say "x"')]
    assert sorted(r["line"] for r in bad.collect()) == ["a,b,c", "only"]
    arrays, rejected = files.checked_arrays(spark, str(f))
    assert [r["fields"] for r in arrays.orderBy("row_no").collect()][0] == ["k", "v"] and rejected.count() == 2
    empty = tmp_path / "e.csv"
    empty.write_text("")
    assert files.checked_records(spark, str(empty))[0].count() == 0
    twice = tmp_path / "t.csv"
    twice.write_text("k,k\n1,2\n")
    assert files.checked_records(spark, str(twice))[0].first()["fields"] == {"k": "2"}


def test_long_csv_lines_take_linear_time(spark, tmp_path):
    f = tmp_path / "l.csv"
    f.write_text("a,b\n" + ",".join(["x"] * 50_000) + "\n" + '"' + "y," * 100_000 + '",z\n')
    good, bad = files.checked_records(spark, str(f))
    assert good.count() == 1 and bad.count() == 1


def _owl(classes: str, imports: str = "") -> str:
    return (
        '<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="http://www.w3.org/2002/07/owl#" '
        f'xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#"><owl:Ontology rdf:about="http://x.example/o">{imports}</owl:Ontology>{classes}</rdf:RDF>'
    )


def test_taxonomy_imports(spark, tmp_path):
    main, other = tmp_path / "main.owl", tmp_path / "other.owl"
    main.write_text(_owl('<owl:Class rdf:about="http://x.example/o#Boxes"/>', '<owl:imports rdf:resource="http://x.example/more"/>'))
    back = '<owl:imports rdf:resource="http://x.example/o"/>'
    other.write_text(_owl('<owl:Class rdf:about="http://x.example/more#Crates"><rdfs:subClassOf rdf:resource="http://x.example/o#Boxes"/></owl:Class>', back))
    where = {"http://x.example/more": str(other), "http://x.example/o": str(main)}
    nodes, _ = files.read_taxonomy(spark, str(main), where)
    assert {(r["name"], r["parent"]) for r in nodes.collect()} == {("Boxes", None), ("Crates", "Boxes")}
    with pytest.raises(ValueError):
        files.read_taxonomy(spark, str(main))


def test_catalogue_counts_and_lookup(spark):
    names = spark.createDataFrame([("x_table_00_a",), ("x_table_00_a",), ("a_hidden",), ("odd",)], "name string")
    rows = spark.createDataFrame([("x_table_00_a",)] * 3, "table_name string")
    got = {tuple(r) for r in files.catalogue(names, rows).collect()}
    assert got == {("x_table_00_a", "x", 3, None, None), ("odd", "", 0, None, None)}
    tables = spark.createDataFrame([("t", "Land A"), ("u", None)], "table_name string, country string")
    assert files.country_of_table(tables, "t").first()["country"] == "land a" and files.country_of_table(tables, "v").count() == 0
    assert files.table_columns(tables) == [("table_name", "string"), ("country", "string")]


def test_country_prefixes(spark):
    rows = spark.createDataFrame([("t", 0, [(0, "Land A speed", "1"), (1, "land a", "2"), (2, "speed 2", "3"), (3, "land a speed 2", "4"), (4, None, "5")]), ("u", 0, [(0, "x y", "1")])], CELLS)
    tables = spark.createDataFrame([("t", "Land A"), ("u", None)], "table_name string, country string")
    got = {r["table_name"]: [c["name"] for c in r["cells"]] for r in cleaning.strip_country(rows, tables).collect()}
    assert got == {"t": ["speed", "land a", "speed 2", "land a speed 2", None], "u": ["x y"]}


def test_class_columns(spark):
    hits = spark.createDataFrame([("x", "Boat", "class", None), ("x", "Size", "data property", "length"), ("y", "Car", "class", "role"), ("z", "Mast", "class", None)], "text string, entity string, kind string, super_col string")
    of = spark.createDataFrame([("Boat", "speed"), ("Boat", "weight"), ("Boat", None), ("Car", "note")], "entity string, super_col string")
    got = {tuple(r) for r in mapping.class_columns(hits, of).collect()}
    assert got == {("x", "Boat", "class", "speed"), ("x", "Boat", "class", "weight"), ("x", "Size", "data property", "length"), ("y", "Car", "class", "role"), ("z", "Mast", "class", None)}


def test_rules_are_only_skipped_where_their_text_is_missing(spark):
    assert taxonomy.literal_of(r"\bpatrol boats?\b") in "patrol boats" and taxonomy.literal_of(r"\bpatrol boats?\b")
    assert taxonomy.literal_of("(ship|boat)") == taxonomy.literal_of(r"\bkiss?\b") == taxonomy.literal_of(".*") == ""
    nodes = spark.createDataFrame([("Patrol boat", "class"), ("Kiss", "class"), ("Tanks", "class")], "name string, kind string")
    texts = spark.createDataFrame([("PATROL BOATS of old",), ("Kiss",), ("tank",), ("tanker",), (None,), ("",)], "text string")
    got = {(r["text"], r["entity"]) for r in taxonomy.match_rules(texts, taxonomy.name_rules(nodes)).collect()}
    assert got == {("PATROL BOATS of old", "Patrol boat"), ("Kiss", "Kiss"), ("tank", "Tanks")}


def test_fingerprints_and_frequencies(spark):
    tables = spark.createDataFrame([(1, "Land ships", None, "Old tanks "), (2, None, "", None)], "table_name int, section_h2 string, section_h3 string, section_h4 string")
    kinds = spark.createDataFrame([(1, "b"), (1, "a"), (1, None)], "table_name int, category string")
    cols = spark.createDataFrame([(1, "Max Speeds"), (2, None)], "table_name int, column_name string")
    got = {r["table_name"]: tuple(r["profile"]) for r in legacy.fingerprints(tables, kinds, cols).collect()}
    assert got == {1: (["land_ship"], ["land_ship"], ["a", "b"], ["max_speed"]), 2: ([], [], [], [])}
    features = spark.createDataFrame([("t", "k", "x"), ("t", "k", "x"), ("u", "k", "x"), ("u", "k", "y")], "table_name string, kind string, feature string")
    members = spark.createDataFrame([("t", "g"), ("u", "g"), ("v", "g")], "table_name string, grp string")
    assert {(r["feature"], round(r["frequency"], 6)) for r in classification.group_frequencies(features, members).collect()} == {("x", 0.666667), ("y", 0.333333)}


def test_a_row_takes_part_in_master_without_a_mapping_or_cells(spark):
    rows = spark.createDataFrame([("t", 0, [(0, "a", "1"), (1, "b", None), (2, "a", "2")]), ("t", 1, None), ("u", 0, [(0, "a", "9")])], CELLS)
    told = spark.createDataFrame([("t", "a", "role", 0), ("t", "b", "cost", 1), ("t", "a", "note", 0)], "table_name string, raw_col string, super_col string, ord int")
    heads = spark.createDataFrame([("t", "url", "Land", None, "Boat")], "table_name string, url string, country string, class_path string, sub_class string")
    got = {(r["table_name"], r["row_idx"]): (r["role"], r["cost"], r["note"], r["country"]) for r in mapping.build_master(rows, told, heads).collect()}
    assert got == {("t", 0): ("1; 2", None, "1; 2", "Land"), ("t", 1): (None, None, None, "Land"), ("u", 0): (None, None, None, None)}


def test_create_table_as(spark):
    sinks.create_table_as(spark.range(3), "loomtab_test_table")
    try:
        sinks.create_table_as(spark.range(2), "loomtab_test_table")
        assert spark.table("loomtab_test_table").count() == 2 and files.table_exists(spark, "loomtab_test_table")
    finally:
        spark.sql("DROP TABLE loomtab_test_table")


def test_pipeline_with_time_order_and_properties(spark, tmp_path):
    nodes = spark.createDataFrame([("Equipment", "class", None), ("Boat", "class", "Equipment"), ("Car", "class", "Equipment")], "name string, kind string, parent string")
    rules = spark.createDataFrame([("Boat", "class", r"\bboats?\b", None), ("Car", "class", r"\bcars?\b", None), ("Count", "data property", r"\bheld\b", "quantity")], "entity string, kind string, pattern string, super_col string")
    page = "<h2>Boats</h2><table><tr><th>Land A boat<th>Held</tr><tr><td>B-1<td>3</tr></table><h2>Odd</h2><table><tr><th>boat<th>Held</tr><tr><td>B-2<td>4</tr></table>"
    pages = spark.createDataFrame([(1, "Land A", "u", page)], "page_id bigint, country string, url string, html string")
    of = spark.createDataFrame([("Boat", "equip_type")], "entity string, super_col string")
    p = Pipeline(spark, str(tmp_path), "r", nodes, rules, Compat(one_by_one=True), of)
    p.acquire(pages, dt.datetime(2020, 5, 1))
    assert {r["scrape_timestamp"] for r in spark.read.parquet(p.path("RAW", "tables")).collect()} == {dt.datetime(2020, 5, 1)}
    p.clean()
    assert {r["column_name"] for r in spark.read.parquet(p.path("CLEANED", "columns")).collect()} == {"boat", "held"}
    p.classify()
    got = {r["section_title"] if "section_title" in r else r["leaf_header"]: r["equipment_class"] for r in spark.read.parquet(p.path("CLASSIFIED", "classes")).collect()}
    assert got == {"Boats": "Boat", "Odd": "Boat"}
    master = spark.read.parquet(p.path("CLASSIFIED", "master"))
    assert {(r["equip_type"], r["quantity"]) for r in master.collect()} == {("B-1", "3"), ("B-2", "4")}
    assert spark.read.parquet(p.path("CLASSIFIED", "unclassified")).where(F.col("equipment_class").isNotNull()).count() == 0


def test_properties_climb_to_descendants(spark, tmp_path):
    f = tmp_path / "p.owl"
    domain = '<owl:DatatypeProperty rdf:about="http://x.example/o#HasDraught"><rdfs:domain rdf:resource="http://x.example/o#Boats"/><super_col>dimensions</super_col></owl:DatatypeProperty>'
    f.write_text(_owl('<owl:Class rdf:about="http://x.example/o#Boats"/>' + domain + '<owl:DatatypeProperty rdf:about="http://x.example/o#Free"/>'))
    domains = files.read_domains(spark, str(f))
    assert {tuple(r) for r in domains.collect()} == {("HasDraught", "Boats", "dimensions")}
    nodes = spark.createDataFrame([("Boats", "class", None), ("Tugs", "class", "Boats"), ("Cars", "class", None), ("HasDraught", "data property", None)], "name string, kind string, parent string")
    paths = taxonomy.paths(nodes)
    got = {tuple(r) for r in taxonomy.properties_of_classes(domains, paths).collect()}
    assert got == {("Boats", "HasDraught", "dimensions"), ("Tugs", "HasDraught", "dimensions")}
    assert taxonomy.entities(nodes).count() == 4 and taxonomy.entities(nodes, "class").count() == 3
    assert {r["name"] for r in taxonomy.descendants(paths, "Boats").collect()} == {"Boats", "Tugs"} and taxonomy.descendants(paths, "x").count() == 0


def test_ensure_table_makes_an_empty_one_and_keeps_a_full_one(spark, tmp_path):
    from loomtab.schemas import TABLES_META

    path = str(tmp_path / "meta")
    empty = files.ensure_table(spark, path, TABLES_META)
    assert empty.count() == 0 and empty.columns == TABLES_META.fieldNames()
    spark.createDataFrame([("t",)], "table_name string").write.mode("overwrite").parquet(path)
    assert files.ensure_table(spark, path, TABLES_META).count() == 1


def test_top_rows(spark):
    from loomtab.operators.summary import top_rows

    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3), ("d", None), (None, 2)], "k string, n int")
    assert [(r["k"], r["place"]) for r in top_rows(df, "n", "k", 4).orderBy("place").collect()] == [("b", 1), ("c", 2), (None, 3), ("a", 4)]
    assert top_rows(df.limit(0), "n", "k", 3).count() == 0
