from loomtab.sources import html as H

PAGE = """
<h2>First</h2><h3>Sub</h3><h4>Deep</h4>
<table class="wikitable sortable"><tr><th colspan="3">Banner</th></tr>
<tr><th>Name<th>Qty<th>Qty</tr>
<tr><td rowspan=2>Alpha</td><td>3</td><td>x</td></tr>
<tr><td>4<td>y
<tr><td colspan=2>Wide</td></tr></table>
<h3>Other</h3><table><tr><td>one</td></tr><tr><td>two</td></tr></table>
<h2>References</h2><table><tr><th>a<th>b<tr><td>1<td>2</table>
<h2>Nested</h2><div class="reflist"><table><tr><th>a<th>b<tr><td>1<td>2</table></div>
<table class="toc"><tr><th>a<th>b<tr><td>1<td>2</table>
<div role="navigation" class="navbox x"><p><table><tr><th>a<th>b<tr><td>1<td>2</table></div>
<table><tr><th>Contents</th><th>b</th></tr><tr><td>1<td>2</table>
<table><tr><th>out<th>er</tr><tr><td>z<td><table><tr><td>in</td></tr></table></td></tr></table>
"""


def tables(spark, page=PAGE):
    pages = spark.createDataFrame([(1, "Land", "u", page), (2, "Land", "u", None)], "page_id bigint, country string, url string, html string")
    return H.extract_tables(pages)


def test_context_and_junk(spark):
    wanted = H.wanted_tables(tables(spark)).collect()
    assert {(r["table_idx"], r["section_title"], r["table_name"]) for r in wanted} == {
        (0, "First_Sub_Deep", "land_table_00_first_sub_deep"), (1, "First_Other_Deep", "land_table_01_first_other_deep"), (2, "Nested", "land_table_02_nested"),
    }


def test_spans_headers_and_duplicate_names(spark):
    rows = sorted((r["row_idx"], [(c["name"], c["value"]) for c in r["cells"]]) for r in tables(spark).where("table_no = 0").collect())
    assert [x for x, _ in rows] == [0, 1, 2, 3]
    grid = [[v for _, v in cells] for _, cells in rows]
    assert [n for n, _ in rows[0][1]] == ["Name", "Qty", "Qty.1"]
    assert grid == [["Banner"] * 3, ["Alpha", "3", "x"], ["Alpha", "4", "y"], ["Wide", "Wide", None]]


def test_headerless_and_blank_names():
    assert H.column_names(["", "a", "a", None]) == ["Unnamed: 0", "a", "a.1", "Unnamed: 3"]
    rows = list(H.page_tables("<table><tr><td>one</td></tr><tr><td>two</td></tr></table>"))
    assert [r["cells"][0]["value"] for r in rows] == ["two"] and rows[0]["h2"] is None
    assert list(H.page_tables("<table></table>"))[0]["row_idx"] is None
    assert list(H.page_tables("<table><tr><td>x")) and list(H.page_tables("no table")) == [] and list(H.page_tables(None)) == []


def test_spans():
    assert [H.span(v) for v in ('13"', "2[a]", "4†", None, "x", "999999999")] == [13, 2, 4, 1, 1, 1000]


def test_deep_nesting_does_not_recurse():
    assert list(H.page_tables("<div>" * 20_000 + "<table><tr><td>a<td>b<tr><td>1<td>2</table>"))[0]["cells"][0]["value"] == "1"


def test_links(spark):
    page = """<section><h2> Land A </h2><ul><li><a href="/wiki/X">X</a> <a href="/wiki/no">n</a><li>no link
      <li><b><a href="https://w.example/wiki/Y">Y y</a></b><li><a href="//w.example/wiki/Z">Z</a><li><a href="/wiki/File:Q">q</a>
      <li><a href="https://other.example/wiki/N">n</a></ul></section><section><li><a href="/wiki/H">h</a></section>"""
    got = H.extract_links(spark.createDataFrame([(page,), (None,)], "html string"), "https://w.example").orderBy("link_pos").collect()
    assert [(r["country"], r["page_title"], r["url"]) for r in got] == [
        ("Land A", "X", "https://w.example/wiki/X"), ("Land A", "Y y", "https://w.example/wiki/Y"), ("Land A", "Z", "https://w.example/wiki/Z"),
    ]


def test_a_cell_may_span_very_many_rows():
    body = "".join(f"<tr><td>{i}" for i in range(2, 2_001))
    for high in ("2000", "65534", "9999999"):
        rows = list(H.page_tables(f"<table><tr><th>k<th>v<tr><td rowspan={high}>all<td>1{body}</table>"))
        assert [[c["value"] for c in r["cells"]] for r in rows] == [["all", str(i)] for i in range(1, 2_001)]
