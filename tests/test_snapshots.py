import random
from datetime import datetime, timedelta

from loomtab.operators import drift
from loomtab.operators.snapshots import snapshot_chain, snapshot_changes

META = "meta_id bigint, table_name string, scrape_timestamp timestamp_ntz"
ITEMS = "meta_id bigint, item_no bigint, row_id bigint, quantity_clean bigint, sign int, field string"
T0 = datetime(2024, 1, 1)


def history(seed):
    rng = random.Random(seed)
    meta, rows, rid = [], [], 0
    for t in range(4):
        for k in range(rng.randint(1, 5)):
            at = T0 + timedelta(hours=rng.choice([k, 20 * k, 500 * k]))
            for _ in range(rng.randint(1, 2)):
                mid = len(meta) + 1
                meta.append((mid, f"t{t}", at))
                for _ in range(rng.randint(0, 8)):
                    rid += 1
                    rows.append((mid, rng.choice([None, *range(5)]), rid, rng.choice([None, 1, 2]), 7, "x"))
    rng.shuffle(meta)
    return meta, rows


def brute(meta, rows):
    groups = {}
    for m, t, at in meta:
        groups.setdefault((t, at), []).append(m)
    snap = {m: min(ms) for ms in groups.values() for m in ms}
    items = {}
    for m, item, _, q, *_ in sorted(rows, key=lambda r: r[2]):
        if item is not None:
            items.setdefault(snap[m], {})[item] = q
    out = set()
    for t in {t for t, _ in groups}:
        line = [min(groups[t, at]) for at in sorted(a for x, a in groups if x == t)]
        for a, b in zip(line, line[1:]):
            old, new = items.get(a, {}), items.get(b, {})
            out |= {(b, i, "added") for i in new.keys() - old.keys()} | {(b, i, "removed") for i in old.keys() - new.keys()}
            out |= {(b, i, "changed") for i in new.keys() & old.keys() if new[i] != old[i]}
    return out


def test_changes_equal_brute_force(spark):
    for seed in range(3):
        meta, rows = history(seed)
        got = snapshot_changes(spark.createDataFrame(rows, ITEMS), spark.createDataFrame(meta, META))
        assert {(r["meta_id"], r["item_no"], r["change_kind"]) for r in got.collect()} == brute(meta, rows)


def test_changed_fields_are_named(spark):
    meta = [(1, "a", T0), (2, "a", T0 + timedelta(days=1))]
    rows = [(1, 1, 1, 5, 1, "x"), (2, 1, 2, 5, 1, "y"), (2, 2, 3, None, 1, "z")]
    got = snapshot_changes(spark.createDataFrame(rows, ITEMS), spark.createDataFrame(meta, META), fields=("quantity_clean", "field"))
    assert {(r["item_no"], r["change_kind"], tuple(r["changed_fields"])) for r in got.collect()} == {(1, "changed", ("field",)), (2, "added", ())}


def test_nulls_and_empty(spark):
    meta = [(1, "a", None), (2, None, T0), (3, "a", T0), (3, "a", T0)]
    chain = snapshot_chain(spark.createDataFrame(meta, META)).collect()
    assert [(r["meta_id"], r["prev_id"], r["next_id"]) for r in chain] == [(3, None, None)]
    none = snapshot_changes(spark.createDataFrame([], ITEMS), spark.createDataFrame([], META))
    assert none.count() == 0 and none.columns == ["meta_id", "item_no", "change_kind", "changed_fields"]


COLS = "meta_id bigint, table_name string, column_name string, pos int, value_type string, family string"


def drift_case(spark, versions, feeds=None):
    """versions: per scrape a dict of column -> type; feeds: per scrape a dict of field -> columns."""
    from loomtab.schemas import MAPPED_FIELDS

    meta = [(i + 1, "t", T0 + timedelta(days=i)) for i in range(len(versions))]
    cols = [(i + 1, "t", c, p, ty, "clash") for i, v in enumerate(versions) for p, (c, ty) in enumerate(v.items())]
    maps = [(i + 1, "t", *[(f or {}).get(x) for x in MAPPED_FIELDS]) for i, f in enumerate(feeds or [None] * len(versions))]
    schema = "meta_id bigint, table_name string, " + ", ".join(f"{f} string" for f in MAPPED_FIELDS)
    return spark.createDataFrame(cols, COLS), spark.createDataFrame(maps, schema), spark.createDataFrame(meta, META)


def steps(spark, *case):
    return {(r["meta_id"], r["change_kind"], r["old_name"], r["new_name"]) for r in drift.migration_steps(*drift_case(spark, *case)).collect()}


def test_rename_needs_one_pair_in_one_field(spark):
    versions = [{"Name": "TEXT", "qty": "int", "x": None}, {"model": "text", "in_service": "float64", "x": "DATE"}, {"model ": "object", "In Service": "REAL", "total": "BIGINT", "x": "text"}]
    feeds = [{"equip_type": "name", "quantity": "qty"}, {"equip_type": "model", "quantity": "in service"}, {"equip_type": "model", "quantity": "in service, total"}]
    assert steps(spark, versions, feeds) == {
        (2, "renamed", "name", "model"), (2, "renamed", "qty", "in service"), (2, "retyped", "qty", "in service"),
        (3, "added", "", "total"), (3, "retyped", "x", "x"),
    }


def test_two_in_a_field_are_no_rename(spark):
    feeds = [{"quantity": "a, b"}, {"quantity": "c"}]
    assert steps(spark, [{"a": "int", "b": "int"}, {"c": "int"}], feeds) == {(2, "removed", "a", ""), (2, "removed", "b", ""), (2, "added", "", "c")}


def test_snapshot_without_columns_removes_all(spark):
    assert steps(spark, [{"a": "int"}, {}, {"a": "int"}]) == {(2, "removed", "a", ""), (3, "added", "", "a")}


def test_empty_drift(spark):
    cols, maps, meta = drift_case(spark, [{"a": "int"}])
    assert drift.migration_steps(cols.limit(0), maps.limit(0), meta.limit(0)).count() == 0


def test_rows_follow_chained_renames(spark):
    versions = [{"a": "int", "k": "text"}, {"b": "int", "k": "text"}, {"c": "int", "k": "text", "new": "date"}]
    feeds = [{"quantity": "a"}, {"quantity": "b"}, {"quantity": "c"}]
    cols, maps, meta = drift_case(spark, versions, feeds)
    raw = spark.createDataFrame(
        [(1, "t", 0, [(0, "A", "1,000"), (1, "k", "x")]), (2, "t", 0, [(0, "b", "2"), (1, "k", None)]), (3, "t", 0, [(0, "c", "z"), (2, "New", "2020-01-02")])],
        "meta_id bigint, table_name string, row_idx int, cells array<struct<pos:int,name:string,value:string>>",
    )
    got = {(r["meta_id"], r["column_name"]): (r["value"], r["value_cast"]) for r in drift.consistent_rows(raw, cols, maps, meta).collect()}
    assert got == {
        (1, "c"): ("1,000", "1000"), (2, "c"): ("2", "2"), (3, "c"): ("z", None),
        (1, "k"): ("x", "x"), (2, "k"): (None, None), (3, "k"): (None, None),
        (1, "new"): (None, None), (2, "new"): (None, None), (3, "new"): ("2020-01-02", "2020-01-02 00:00:00"),
    }


def test_versions(spark):
    got = drift.schema_versions(*drift_case(spark, [{"a": "int", "b": "text"}, {"B": "VARCHAR", "A": "BIGINT"}, {"a": "int"}])).collect()
    assert {r["meta_id"]: (r["n_columns"], r["is_new_version"]) for r in got} == {1: (2, True), 2: (2, False), 3: (1, True)}


def test_rows_keep_both_cells_of_a_removed_and_a_renamed_column(spark):
    versions = [{"a": "int", "b": "int"}, {"a": "int"}, {"b": "int"}, {"c": "int"}]
    cols, maps, meta = drift_case(spark, versions[:3], [{"quantity": "a"}, {"quantity": "a"}, {"quantity": "b"}])
    schema = "meta_id bigint, table_name string, row_idx int, cells array<struct<pos:int,name:string,value:string>>"
    raw = spark.createDataFrame([(1, "t", 0, [(0, "A", "1"), (1, "B", "2")]), (2, "t", 0, [(0, "a", "3")]), (3, "t", 0, [(0, "b", "4")])], schema)
    old = f"b (until {T0 + timedelta(days=1)})"
    got = {(r["meta_id"], r["column_name"]): r["value"] for r in drift.consistent_rows(raw, cols, maps, meta).collect()}
    assert got == {(1, "b"): "1", (1, old): "2", (2, "b"): "3", (2, old): None, (3, "b"): "4", (3, old): None}
    # the name goes on to another one, and the removed column stays apart
    cols, maps, meta = drift_case(spark, versions, [{"quantity": "a"}, {"quantity": "a"}, {"quantity": "b"}, {"quantity": "c"}])
    got = {(r["meta_id"], r["column_name"]): r["value"] for r in drift.consistent_rows(raw, cols, maps, meta).collect()}
    assert got == {(1, "c"): "1", (1, old): "2", (2, "c"): "3", (2, old): None, (3, "c"): "4", (3, old): None}
    # without a clash a column that comes again shares its name
    cols, maps, meta = drift_case(spark, [{"b": "int"}, {}, {"b": "int"}])
    again = spark.createDataFrame([(1, "t", 0, [(0, "b", "1")]), (3, "t", 0, [(0, "b", "2")])], schema)
    got = {(r["meta_id"], r["column_name"]): r["value"] for r in drift.consistent_rows(again, cols, maps, meta).collect()}
    assert got == {(1, "b"): "1", (3, "b"): "2"}


def test_cells_of_one_column_and_unlisted_ones_all_stay(spark):
    cols, maps, meta = drift_case(spark, [{"qty": "int", "Qty_": "int"}, {"n": "int"}], [{"quantity": "qty"}, {"quantity": "n"}])
    schema = "meta_id bigint, table_name string, row_idx int, cells array<struct<pos:int,name:string,value:string>>"
    raw = spark.createDataFrame([(1, "t", 0, [(0, "QTY", "1"), (1, "qty_", "2"), (2, "other", "3"), (3, None, "4")]), (9, "t", 0, [(0, "z", "5")]), (2, "t", 1, None)], schema)
    got = {(r["meta_id"], r["column_name"], r["value_no"]): (r["value"], r["family"]) for r in drift.consistent_rows(raw, cols, maps, meta).collect()}
    whole = "whole number"
    assert got == {
        (1, "n", 1): ("1", whole), (1, "n", 2): ("2", whole), (1, "other", 1): ("3", None),
        (9, "z", 1): ("5", None), (9, "n", 1): (None, whole), (2, "n", 1): (None, whole),
    }
    assert [(r["meta_id"], r["name"], r["raw_names"]) for r in drift.clashing_names(cols, meta).collect()] == [(1, "qty", ["Qty_", "qty"])]


def test_equal_fingerprints_make_no_step_and_fields_count(spark):
    cols, maps, meta = drift_case(spark, [{"a": "int"}, {"A ": "bigint"}, {"a": "int"}], [{"quantity": "a"}, {"quantity": "a"}, {"cost": "a"}])
    prints = [r["fingerprint"] for r in drift.schema_versions(cols, maps, meta).orderBy("meta_id").collect()]
    assert prints[0] == prints[1] != prints[2]
    assert drift.migration_steps(cols, maps, meta).count() == 0


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest

    from loomtab.session import cut_lineage

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(RuntimeError):
        cut_lineage(SimpleNamespace(sparkSession=session))
