import random

from loomtab.llm.duplicates import DuplicateRuns, canonical_records

SCHEMA = "row_id bigint, table_name string, equip_type string, variant string, record string, n int"


def runs(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    return DuplicateRuns(canonical_records(df, ("equip_type", "variant"), ("table_name",), **kw))


def brute(rows):
    groups = {}
    for i, t, a, b in rows:
        vals = {"".join(c for c in v.lower() if c.isalnum()) for f in (a, b) for v in (f or "").split(";")} - {""}
        if vals:
            groups.setdefault((t, frozenset(vals)), []).append(i)
    return groups


def test_writing_does_not_count(spark):
    rows = [
        (1, "t", "HM 918; Torkisis", "Mk 5"), (2, "t", "torkisis;hm-918", "MK 5!"), (3, "t", "Mk 5", "“HM​918”; Torkisis;;"),
        (4, "u", "HM 918; Torkisis", "Mk 5"), (5, "t", "HM 918; Torkisis", None), (6, "t", "Dreporé", None), (7, "t", "Drepore", ""),
        (8, "t", "DREPORÉ", "—"), (9, "t", "—", None), (10, "t", None, None), (11, None, "a", None), (12, None, "A", None), (13, "", "a", None), (None, "t", "Dreporé", None),
    ]
    r = runs(spark, rows)
    assert sorted(map(tuple, r.copies().collect())) == [(1, 2), (1, 3), (6, 8), (11, 12)]
    assert {tuple(x) for x in r.representatives().collect()} == {(1, 3), (4, 1), (5, 1), (6, 2), (7, 1), (11, 2), (13, 1)}


def test_equals_brute_force_with_a_hot_record(spark):
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        name = "Hot Name" if rng.random() < 0.4 else f"Name {rng.randint(1, 900)}"
        styled = rng.choice([str.upper, str.lower, str.title, lambda s: f"  {s}!", lambda s: s.replace(" ", "-")])(name)
        rows.append((i, f"t{rng.randint(0, 1)}", styled, rng.choice([None, "", "Mk 2"])))
    want = brute(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        r = runs(spark, rows)
        assert {tuple(x) for x in r.copies().collect()} == {(min(ids), i) for ids in want.values() for i in ids if i != min(ids)}
        assert {tuple(x) for x in r.representatives().collect()} == {(min(ids), len(ids)) for ids in want.values()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repeated_ids_long_values_and_empty(spark):
    long = "x" * 300_000
    r = runs(spark, [(1, "t", long, None), (2, "t", long.upper(), None), (3, "t", "a", None), (3, "t", "A", None)])
    assert sorted(map(tuple, r.copies().collect())) == [(1, 2)]
    assert {tuple(x) for x in r.representatives().collect()} == {(1, 2), (3, 2)}
    empty = runs(spark, [])
    assert empty.copies().count() == 0 and empty.representatives().count() == 0
