from decimal import Decimal
from fractions import Fraction

import pytest

from loomtab.functions import units as U
from loomtab.operators.measures import harmonise_measures

ROWS = "row_id bigint, meta_id bigint, note string, displacement string, speed string, length string, caliber string, value string"
MAP = "meta_id bigint, displacement string, speed string, length string, caliber string"


def run(spark, cells, mapping=()):
    """cells: (field, text, note, meta_id)."""
    fields = [f.name for f in U.FIELDS]
    rows = [(i, m, note, *[t if f == name else None for name in fields], "clash") for i, (f, t, note, m) in enumerate(cells)]
    got = harmonise_measures(spark.createDataFrame(rows, ROWS), spark.createDataFrame(list(mapping), MAP)).collect()
    by = {r["row_id"]: r["value_milli"] for r in got}
    return [by.get(i) for i in range(len(cells))]


CASES = [
    ("displacement", "2,185.5 tons", 2185500),
    ("displacement", "2 208 tonnes", 2208000),
    ("displacement", "5 LT", 5080),
    ("displacement", "20.2 l. tons", 20524),
    ("displacement", "3 sh tn", 2722),
    ("displacement", "1.234 t", 1234000),
    ("displacement", "7 kt", 7000000),
    ("displacement", "0.36 ×10³ t", 360000),
    ("displacement", "274.9 tons (long)", 279311),
    ("displacement", "4,739 kilograms", 4739),
    ("displacement", "827 sh tn (750 t)", 750242),
    ("displacement", "2–4 kt", None),
    ("displacement", "12 to 14 tonnes", None),
    ("speed", "twenty knots", 37040),
    ("speed", "48kt, cruising", 88896),
    ("speed", "37.4  kts (69.3 km/h)", 69265),
    ("speed", "10 m/s[2]", 36000),
    ("speed", "Mach 1.9", None),
    ("speed", "M2.3", None),
    ("speed", "2.0 Mach", None),
    ("speed", "11-13 m/s", None),
    ("length", "7′ 6″", 2286),
    ("length", "9 feet 11 inches", 3023),
    ("length", "22ft 2in", 6756),
    ("length", "LOA 1.78 yd", 1628),
    ("length", "1 052 centimetres (10.5 m)", 10520),
    ("length", "8-10 M", None),
    ("caliber", "3 × 192.8 mm", 192800),
    ("caliber", "4x 4.28-inch", 108712),
    ("caliber", ".50 cal", 12700),
    ("caliber", "54 cal", None),
    ("caliber", "1.36\"/50", 34544),
    ("caliber", "16,1 MM L/56", 16100),
    ("caliber", "classified", None),
    ("caliber", "", None),
    ("caliber", "105", None),
]


def test_cells(spark):
    got = run(spark, [(f, t, None, 1) for f, t, _ in CASES])
    assert [(c[1], g) for c, g in zip(CASES, got)] == [(t, want) for _, t, want in CASES]


def test_unit_from_note_and_column(spark):
    cells = [
        ("speed", "15.8", "Crew of three.; (speed: mph)", 1),
        ("speed", "15", "top speed in metres per second", 1),
        ("length", "501", "Given in in: overall length.", 1),
        ("length", "9,72", "Figures for length are m.", 1),
        ("length", "12", "Figures for speed are kn.", 1),
        ("length", "12", None, 2),
        ("caliber", "0.88", None, 2),
        ("caliber", "30 mm", "bore in cm", 2),
        ("displacement", "10*", None, 2),
        ("displacement", "10", None, 3),
    ]
    mapping = [
        (1, "displacement", "speed", "length", "caliber"),
        (2, "full load lt", "speed", "length overall (m)", "bore in"),
        (2, "full load lt", "speed", "length overall (m)", "bore in"),
        (3, "disp. t, full load lt", None, None, None),
    ]
    assert run(spark, cells, mapping) == [25428, 54000, 12725, 9720, None, 12000, 22352, 30000, 10160, None]


def test_long_odd_and_repeated(spark):
    long = "1,1 " * 60_000
    cells = [("length", long, None, 1), ("length", "9" * 200_000 + " m", None, 1), ("length", "(" * 100_000, "x" * 100_000, None), ("length", " " * 300_000 + "3 m", None, 1)]
    assert run(spark, cells) == [None, None, None, 3000]


def test_empty_tables(spark):
    assert harmonise_measures(spark.createDataFrame([], ROWS), spark.createDataFrame([], MAP)).count() == 0


def test_graph_composes_and_checks_cycles():
    to = U.compose(U.EDGES, "kelvin")
    assert to["celsius"] == (1, Fraction("273.15"))
    s, o = to["fahrenheit"]
    assert s * 32 + o == Fraction("273.15")
    with pytest.raises(U.InconsistentUnits):
        U.compose((*U.EDGES, ("foot", "millimetre", "305", "0")), "metre")


def test_conversions_are_exact():
    rows = {(f, t): s for f, t, _, s, _ in U.conversion_rows()}
    assert rows["displacement", "long tons"] == Decimal("1.0160469088")
    assert rows["caliber", "cal"] == Decimal("25.4")
    assert rows["length", "yd"] == Decimal("0.9144")
