import os

import pytest

from loomtab.llm.mixing import Mix
from loomtab.llm.tokens import VOCABULARY

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no public vocabulary here")
DOCS = "doc_id bigint, text string, source string, copies int"
TARGETS = "mix_name string, source string, target_share double, max_repeats int"


def mix(spark, docs, targets, **kw):
    return Mix(spark.createDataFrame([(*d, 1) for d in docs], DOCS), spark.createDataFrame(targets, TARGETS), **kw)


def test_shares_and_caps(spark):
    docs = [(i, "one two three four five six seven", "big") for i in range(4000)] + [(10_000 + i, "one two three four", "small") for i in range(300)]
    docs += [(20_000, None, "big"), (20_001, "", "small"), (20_002, "no source", None), (20_003, "elsewhere", "other")]
    m = mix(spark, docs, [("m", "big", 0.8, 2), ("m", "small", 0.2, 4)])
    report = {r["source"]: r for r in m.report().collect()}
    assert report["small"]["rate"] == 4.0 and report["small"]["most_repeats"] == 4
    assert abs(report["big"]["actual_share"] - 0.8) < 0.02 and abs(sum(r["actual_share"] for r in report.values()) - 1) < 1e-9
    rows = m.emitted().collect()
    assert {r["doc_id"] for r in rows if r["source"] == "small"} == set(range(10_000, 10_300))
    assert max(r["copy_no"] for r in rows if r["source"] == "big") <= 2
    again = mix(spark, docs, [("m", "big", 0.8, 2), ("m", "small", 0.2, 4)]).emitted().collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_missing_and_unusable_sources(spark):
    docs = [(i, "a b c", "x") for i in range(50)]
    targets = [("m", "x", 0.5, 3), ("m", "gone", 0.5, 9), ("m", "bad", None, 1), ("m", None, 0.1, 1), ("n", "gone", 1.0, 1), ("z", "x", 0.0, 1)]
    report = {(r["mix_name"], r["source"]): r for r in mix(spark, docs, targets).report().collect()}
    assert report["m", "x"]["actual_share"] == 1.0 and report["m", "x"]["rate"] == 3.0
    assert report["m", "gone"]["mixed_tokens"] == 0 and report["n", "gone"]["actual_share"] == 0.0 and report["z", "x"]["rate"] == 0.0
    assert len(report) == 5


def test_a_wanted_size_is_not_cut_by_a_scarce_source(spark):
    sized = spark.createDataFrame([(i, "big", 10) for i in range(2000)] + [(9000 + i, "tiny", 10) for i in range(5)], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("m", "big", 0.5, 3), ("m", "tiny", 0.5, 1)], TARGETS)
    report = {r["source"]: r for r in Mix.of_sizes(sized, targets, size=8000).report().collect()}
    assert report["tiny"]["mixed_tokens"] == 50 and abs(report["big"]["mixed_tokens"] - 4000) < 500
    exact = {r["source"]: r for r in Mix.of_sizes(sized, targets).report().collect()}
    assert exact["tiny"]["mixed_tokens"] == 50 and exact["big"]["rate"] == 50 / 20000


def test_empty(spark):
    m = mix(spark, [], [("m", "x", 1.0, 1)])
    assert m.emitted().count() == 0 and m.report().count() == 1
    assert mix(spark, [(1, "a", "x")], []).report().count() == 0
