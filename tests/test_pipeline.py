import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomtab.operators import taxonomy
from loomtab.plans.pipeline import Pipeline
from loomtab.sources import files, sinks

OWL = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="http://www.w3.org/2002/07/owl#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns="http://x.example/o#">
<owl:Class rdf:about="http://x.example/o#Equipment"><hasRegex>REGEX:(equipment)</hasRegex></owl:Class>
<owl:Class rdf:about="http://x.example/o#Vessel"><rdfs:subClassOf rdf:resource="http://x.example/o#Equipment"/><hasRegex>regex:(vessel|ship)</hasRegex></owl:Class>
<owl:Class rdf:about="http://x.example/o#Frigate"><rdfs:subClassOf rdf:resource="http://x.example/o#Vessel"/><hasRegex>frigate</hasRegex></owl:Class>
<owl:Class rdf:about="http://x.example/o#Tank"><rdfs:subClassOf rdf:resource="http://x.example/o#Equipment"/><hasRegex>tank</hasRegex></owl:Class>
<owl:DatatypeProperty rdf:about="http://x.example/o#IsType"><hasRegex>REGEX:(system)</hasRegex><super_col>equip_type</super_col></owl:DatatypeProperty>
<owl:DatatypeProperty rdf:about="http://x.example/o#HasQuantity"><hasRegex>REGEX:(in service)</hasRegex><super_col>quantity</super_col></owl:DatatypeProperty>
</rdf:RDF>"""
PAGE = """<h2>Frigates</h2><table><tr><th>System<th>In service<th>Image</tr>
<tr><td>F-1<td>3<td>x</tr><tr><td>F-2<td>12 (1998)<td>y</tr></table>
<h2>Tanks</h2><table><tr><th>Model<th>In service</tr><tr><td colspan=2>Light tanks (40)</td></tr><tr><td>T-1<td>about 7</tr></table>
<h2>See also</h2><table><tr><th>a<th>b<tr><td>1<td>2</table>"""


def test_all_stages(spark, tmp_path):
    owl = tmp_path / "t.owl"
    owl.write_text(OWL)
    nodes, raw = files.read_taxonomy(spark, str(owl))
    rules = taxonomy.rules_of(raw)
    assert {(r["name"], r["kind"], r["parent"]) for r in nodes.collect()} >= {("Frigate", "class", "Vessel"), ("IsType", "data property", None)}
    assert {r["pattern"] for r in rules.collect()} >= {"(vessel|ship)", "frigate"}
    pages = spark.createDataFrame([(1, "Land A", "u", PAGE)], "page_id bigint, country string, url string, html string")
    p = Pipeline(spark, str(tmp_path / "out"), "r1", nodes, rules)
    got = {(r["country"], r["class_path"], r["sub_class"]): r["total_quantity"] for r in p.run(pages).collect()}
    assert got == {("Land A", "Equipment>Vessel>Frigate", "Frigate"): 15, ("Land A", "Equipment>Tank", "Tank"): 7}
    again = p.run(from_stage="REFINED")
    assert again.count() == 2
    with pytest.raises(ValueError):
        p.run(from_stage="X")
    report = spark.read.parquet(p.path("CLASSIFIED", "report")).where("equipment_class = 'Frigate'").first()
    assert (report["equip_type"], report["quantity"]) == ("system", "in service")
    assert next((tmp_path / "out" / "r1-ANALYZED" / "summary_csv").glob("*.csv")).read_text().startswith("country,class_path,sub_class,total_quantity")


def test_stage_paths(spark, tmp_path):
    assert sinks.next_stage("/x/r-RAW") == "/x/r-CLEANED" and sinks.next_stage("/x/r-REFINED/") == "/x/r-ANALYZED"
    for bad in ("/x/r-ANALYZED", "/x/r"):
        with pytest.raises(ValueError):
            sinks.next_stage(bad)
    path = sinks.write_table(spark.range(3), str(tmp_path / "a"))
    assert spark.read.parquet(sinks.promote(spark, path, str(tmp_path / "b"))).count() == 3


def test_csv_readers(spark, tmp_path):
    links = tmp_path / "links.csv"
    links.write_text("country_name, page_title, url\nLand A , List of x , http://u\n")
    assert tuple(files.curated_links(spark, str(links)).first()) == ("Land A", "List of x", "http://u")
    bad = tmp_path / "bad.csv"
    bad.write_text('k,v\n"a, b","say ""x"""\nonly\nc,d,e\nf,g\n')
    good, rejected = files.checked_records(spark, str(bad))
    assert sorted((r["fields"]["k"], r["fields"]["v"]) for r in good.collect()) == [("a, b", 'say "x"'), ("f", "g")]
    assert sorted(r["line"] for r in rejected.collect()) == ["c,d,e", "only"]
    assert files.records(spark, str(bad)).count() == 5 and files.lines(spark, str(bad)).count() == 5


def test_catalogue(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, pos int, v string")
    assert {tuple(r) for r in files.key_values(df, "k", "v", "pos").collect()} == {("a", "y"), ("b", None)}
    assert {r["k"]: r["v"] for r in files.key_lists(df, "k", "v", "pos").collect()} == {"a": ["x", "y"], "b": [None]}
    assert {tuple(r) for r in files.last_wins(df, "k", ("pos",)).collect()} == {("a", 2, "y"), ("b", 1, None)}
    assert files.drop_tables(df, df.where("k = 'a'"), "k").count() == 1 and files.first_column_set(df, "k").count() == 2
    names = spark.createDataFrame([("land_table_00_x",), ("a_meta_table",), ("odd",)], "name string")
    assert {tuple(r) for r in files.seed_catalogue(names).collect()} == {("land_table_00_x", "land"), ("a_meta_table", ""), ("odd", "")}
    assert files.data_tables(names, "name").count() == 2 and not files.table_exists(spark, "no_such_table")


def test_queries_match_oracles(spark, sf_dir):
    """Every query with an oracle, at the smallest scale."""
    import duckdb

    from verify import canonical
    from pathlib import Path

    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    for name, sql in oracles.items():
        got, want = queries[name](spark, sf_dir).toPandas(), con.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns), name
        assert canonical(got) == canonical(want), name


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0


def test_library_without_llm():
    """Nothing outside the subpackage imports it."""
    from pathlib import Path

    root = Path(entry.__file__).parent / "loomtab"
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "loomtab.llm" not in f.read_text(), f
