"""Units of measure: a conversion graph with affine edges and a size parser.

The graph is data: each edge says ``y = scale * x + offset`` between two units.
Shortest compositions to a target unit come from a breadth-first walk, every
edge that closes a cycle is checked against them, and the resulting small table
(one row per unit) is what the engine joins with. The parser is one set of JVM
regular expressions per field; it never leaves Catalyst.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (from, to, scale, offset) as exact decimals (fixed values).
EDGES: tuple[tuple[str, str, str, str], ...] = (
    ("kilogram", "tonne", "0.001", "0"),
    ("kilotonne", "tonne", "1000", "0"),
    ("pound", "kilogram", "0.45359237", "0"),
    ("long_ton", "pound", "2240", "0"),
    ("short_ton", "pound", "2000", "0"),
    ("long_ton", "kilogram", "1016.0469088", "0"),
    ("short_ton", "kilogram", "907.18474", "0"),
    ("knot", "km_per_hour", "1.852", "0"),
    ("mile_per_hour", "km_per_hour", "1.609344", "0"),
    ("metre_per_second", "km_per_hour", "3.6", "0"),
    ("foot_per_second", "metre_per_second", "0.3048", "0"),
    ("millimetre", "metre", "0.001", "0"),
    ("centimetre", "metre", "0.01", "0"),
    ("kilometre", "metre", "1000", "0"),
    ("inch", "millimetre", "25.4", "0"),
    ("inch", "centimetre", "2.54", "0"),
    ("foot", "metre", "0.3048", "0"),
    ("foot", "inch", "12", "0"),
    ("yard", "foot", "3", "0"),
    ("yard", "metre", "0.9144", "0"),
    ("mile", "yard", "1760", "0"),
    ("mile", "kilometre", "1.609344", "0"),
    ("celsius", "kelvin", "1", "273.15"),
    ("fahrenheit", "rankine", "1", "459.67"),
    ("kelvin", "rankine", "1.8", "0"),
)

#: Ways to write each unit, by kind of quantity (fixed values, lower case, without a final point).
MASS = {
    "tonne": ("t", "tonne", "tonnes", "metric ton", "metric tons", "metric tonnes", "ton", "tons", "mt"),
    "long_ton": ("long ton", "long tons", "lt", "l. ton", "l. tons", "l ton", "l tons", "ton (long)", "tons (long)", "long tn"),
    "short_ton": ("short ton", "short tons", "sh tn", "sh. tn", "sh ton", "sh tons", "s. tons", "ton (short)", "tons (short)", "short tn"),
    "kilogram": ("kg", "kgs", "kilo", "kilos", "kilogram", "kilograms", "kilogramme", "kilogrammes"),
    "pound": ("lb", "lbs", "pound", "pounds"),
    "kilotonne": ("kt", "kilotonne", "kilotonnes", "kiloton", "kilotons", "thousand t", "thousand tonnes", "thousand tons", "thousand metric tons", "×10³ t", "x10³ t", "× 10³ t", "×10^3 t", "10³ t", "×1000 t", "x1000 t", "'000 t"),
}
SPEED = {
    "km_per_hour": ("km/h", "kmh", "kph", "km/hr", "km/hour", "kmph", "km per hour", "kilometres per hour", "kilometers per hour", "kilometre per hour", "kilometer per hour", "km h"),
    "knot": ("kn", "kt", "kts", "kns", "knot", "knots"),
    "mile_per_hour": ("mph", "mi/h", "mi/hr", "miles/h", "miles/hour", "mile per hour", "miles per hour"),
    "metre_per_second": ("m/s", "m/sec", "mps", "metres per second", "meters per second", "metre per second", "meter per second", "m per second"),
    "foot_per_second": ("ft/s", "fps", "feet per second"),
}
LENGTH = {
    "metre": ("m", "mtr", "mtrs", "metre", "metres", "meter", "meters"),
    "centimetre": ("cm", "cms", "centimetre", "centimetres", "centimeter", "centimeters"),
    "millimetre": ("mm", "mms", "millimetre", "millimetres", "millimeter", "millimeters"),
    "kilometre": ("km", "kilometre", "kilometres", "kilometer", "kilometers"),
    "foot": ("ft", "feet", "foot", "′", "'", "’"),
    "inch": ("in", "inch", "inches", "″", '"', "”", "''", "′′"),
    "yard": ("yd", "yds", "yard", "yards"),
    "mile": ("mi", "mile", "miles"),
}
CALIBER = LENGTH | {"caliber_inch": ("cal", "caliber", "calibre", "calibers", "calibres")}


@dataclass(frozen=True)
class Field:
    """How one field is read: its units, its target, and the labels that name it in notes."""

    name: str
    units: dict[str, tuple[str, ...]]
    target: str
    labels: tuple[str, ...]


FIELDS: tuple[Field, ...] = (
    Field("displacement", MASS, "tonne", ("displacement", "disp.", "disp", "full load", "standard load", "tonnage")),
    Field("speed", SPEED, "km_per_hour", ("speed", "velocity")),
    Field("length", LENGTH, "metre", ("length overall", "length", "loa")),
    Field("caliber", CALIBER, "millimetre", ("caliber", "calibre", "bore")),
)


class InconsistentUnits(ValueError):
    """A cycle of the conversion graph does not return the value it started from."""


def compose(edges=EDGES, target: str = "metre") -> dict[str, tuple[Fraction, Fraction]]:
    """``unit -> (scale, offset)`` to ``target`` by the fewest edges.

    Edges work both ways. Each edge between reached units, also one outside the
    shortest tree, must agree with the compositions exactly, else
    :class:`InconsistentUnits` is raised.
    """
    near: dict[str, list[tuple[str, Fraction, Fraction]]] = {}
    for a, b, scale, offset in edges:
        s, o = Fraction(scale), Fraction(offset)
        if s == 0:
            raise InconsistentUnits(f"{a} -> {b} has scale 0")
        near.setdefault(b, []).append((a, s, o))
        near.setdefault(a, []).append((b, 1 / s, -o / s))
    found = {target: (Fraction(1), Fraction(0))}
    queue = deque([target])
    while queue:
        at = queue.popleft()
        s, o = found[at]
        for other, es, eo in near.get(at, ()):
            step = (s * es, s * eo + o)
            if other not in found:
                found[other] = step
                queue.append(other)
            elif found[other] != step:
                raise InconsistentUnits(f"{other} -> {target}: {found[other]} and {step} by way of {at}")
    return found


def conversion_rows(fields: tuple[Field, ...] = FIELDS, edges=EDGES) -> list[tuple[str, str, str, Decimal, Decimal]]:
    """(field, alias, unit, scale, offset) rows; their number is fixed by the lists above, not by data."""
    rows = []
    for f in fields:
        to = compose(edges, f.target)
        for unit, names in f.units.items():
            scale, offset = to["inch" if unit == "caliber_inch" else unit]
            for name in names:
                rows.append((f.name, name, unit, _decimal(scale), _decimal(offset)))
    return rows


def _decimal(x: Fraction) -> Decimal:
    return (Decimal(x.numerator) / Decimal(x.denominator)).quantize(Decimal("1.000000000000"))


def conversions(spark: SparkSession, fields: tuple[Field, ...] = FIELDS) -> DataFrame:
    return spark.createDataFrame(
        conversion_rows(fields), "field_name string, unit_text string, unit string, scale decimal(22,12), offset decimal(22,12)"
    )


# --- the parser -------------------------------------------------------------------------------------------------

_ONES = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
_TEENS = ("ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen")
_TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")


def number_words() -> dict[str, int]:
    """Number words from one to ninety-nine, and a hundred, by rule."""
    words = {w: i + 1 for i, w in enumerate(_ONES)} | {w: i + 10 for i, w in enumerate(_TEENS)}
    for i, ten in enumerate(_TENS):
        words[ten] = 20 + 10 * i
        words |= {f"{ten}{sep}{one}": 20 + 10 * i + j + 1 for j, one in enumerate(_ONES) for sep in "- "}
    return words | {"a hundred": 100, "one hundred": 100, "hundred": 100}


_WORDS = number_words()
_WORD_RX = "|".join(sorted(map(re.escape, _WORDS), key=len, reverse=True)).replace(r"\-", "-").replace(r"\ ", " ")
#: A number: grouped by spaces, or with points and commas, or in words. Repeats are bounded so that long digit strings can't exhaust the stack.
NUMBER = rf"(?<![\p{{L}}\d])(?:\d{{1,3}}(?: \d{{3}}){{1,6}}(?!\d)(?:[.,]\d++)?|[.,]?\d++(?:[.,]\d++){{0,8}}|(?:{_WORD_RX})(?!\p{{L}}))"
_DASH = r"(?:-|–|—|‒|−|\bto\b|\.\.+|…)"


def _quote(alias: str) -> str:
    return re.sub(r"([.()\[\]^$*+?|/{}\\])", r"\\\1", alias).replace(" ", r"\s?")


def unit_pattern(field: Field) -> str:
    """All ways to write the field's units, longest first, so that ``tons (long)`` comes before ``tons``."""
    names = sorted({n for names in field.units.values() for n in names}, key=len, reverse=True)
    ways = (_quote(n) + (r"(?![\p{L}\d³²])\.?" if n[-1].isalpha() else "") for n in names)
    return rf"(?:{'|'.join(ways)})"


def _tidy(c: Column) -> Column:
    """Lower case, one kind of space, no footnote marks in brackets."""
    c = F.regexp_replace(c, r"[\s\p{Z}]+", " ")
    c = F.regexp_replace(c, r"\p{Cf}", "")
    return F.trim(F.lower(F.regexp_replace(c, r"\[[^\[\]]*+\]", " ")))


def _unit_text(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"\s+", " "), r"(?<=\p{L})\.$", "")


def number_value(c: Column) -> Column:
    """A written number as a decimal.

    A comma or point before exactly three digits groups thousands unless the
    number starts with it; before any other count of digits it is the decimal
    mark. Spaces group. NULL where there are two decimal marks or too many digits.
    """
    words = F.create_map(*[F.lit(x) for kv in _WORDS.items() for x in (kv[0], str(kv[1]))])

    def digits(c: Column) -> Column:
        c = F.regexp_replace(c, " ", "")
        c = F.regexp_replace(c, r"^[.,]", "0@")
        c = F.regexp_replace(c, r"(?<=\d)[.,](?=\d{3}(?!\d))", "")
        # a decimal mark can stand once, and "0@" was set before grouping was undone
        return F.regexp_replace(c, r"[.,]", "@")

    written = F.coalesce(F.try_element_at(words, c), c)
    return let(
        digits(written),
        lambda d: F.when(F.length(F.regexp_replace(d, "[^@]", "")) <= 1, F.regexp_replace(d, "@", ".").try_cast("decimal(18,6)")),
    )


def let(value: Column, then) -> Column:
    """Bind a costly expression once, so that neither generated code nor filter push-down repeats it.

    Higher-order functions are evaluated outside generated methods, which also keeps these under their size limit.
    """
    return F.element_at(F.transform(F.array(value), then), 1)


def tidy(c: Column) -> Column:
    """Lower case, one kind of space, no footnote marks in brackets."""
    return _tidy(c)


PART = "\u0001"


def match_size(field: Field, text: Column) -> Column:
    """ARRAY(before, number, unit, after) of the first sized number of a tidied cell, else one element."""
    sized = rf"(?s)^(.*?)({NUMBER})[ ]?-?[ ]?({unit_pattern(field)})(.*)$"
    return F.split(F.regexp_replace(F.regexp_replace(text, PART, ""), sized, PART.join(("$1", "$2", "$3", "$4"))), PART)


def match_bare(text: Column) -> Column:
    """ARRAY(before, number, after) of the first number of a tidied cell; a leading count (``2 x``) is no size."""
    plain = F.regexp_replace(text, r"^[^\d]{0,12}\d{1,3} ?[x×*] ?(?=[.,]?\d)", "")
    return F.split(F.regexp_replace(plain, rf"(?s)^(.*?)({NUMBER})(.*)$", PART.join(("$1", "$2", "$3"))), PART)


def span_before(before: Column) -> Column:
    """A span ends here: the text before the first size ends in a number and a dash (its unit is left out or short)."""
    return before.rlike(rf"(?:{NUMBER})\s*-?[^\d,;()]{{0,20}}?\s*{_DASH}\s*$")


def span_after(after: Column) -> Column:
    return after.rlike(rf"^\s*{_DASH}\s*(?:{NUMBER})")


def not_of_field(field: Field, text: Column, number: Column, unit: Column) -> Column:
    """Mach numbers are no speeds; counts of calibres are barrel lengths unless they are a part of an inch."""
    if field.name == "speed":
        return text.rlike(r"(?<!\p{L})(?:mach|ma?\.? ?\d)")
    if field.name == "caliber":
        return unit.rlike("^cal") & ~number.rlike("^0?[.,]")
    return F.lit(False)


def inches_after(field: Field, unit: Column, after: Column) -> Column:
    """The inches of a size in feet and inches, or NULL."""
    if "foot" not in field.units:
        return F.lit(None).cast("string")
    feet = "|".join(_quote(n) for n in sorted(field.units["foot"], key=len, reverse=True))
    inch = "|".join(_quote(n) for n in sorted(field.units["inch"], key=len, reverse=True))
    rest = F.regexp_extract(after, rf"^\s*,?(?:and)?\s*({NUMBER})[ ]?-?[ ]?(?:{inch})(?!\p{{L}})", 1)
    return F.when(unit.rlike(rf"^(?:{feet})\.?$"), F.nullif(rest, F.lit("")))


def unit_text(c: Column) -> Column:
    return _unit_text(c)


def note_unit(field: Field, note: Column) -> Column:
    """The unit that a row's tidied note states for this field, or NULL."""
    unit = unit_pattern(field)
    label = "|".join(_quote(n) for n in sorted(field.labels, key=len, reverse=True))
    text = note
    told = rf"(?<!\p{{L}})(?:{label})(?: overall)?(?:\s+(?:are|is|in)(?:\s+(?:given|stated))?(?:\s+in)?\s+|\s*[:=]\s*|\s*\()({unit})(?![\p{{L}}\d])"
    given = rf"(?:given|stated|measured|figures) in ({unit}):?\s*(?:[\p{{L}}]+ ){{0,2}}(?:{label})(?!\p{{L}})"
    a, b = F.regexp_extract(text, told, 1), F.regexp_extract(text, given, 1)
    return F.when(b != "", _unit_text(b)).when(a != "", _unit_text(a))


def column_unit(field: Field, columns: Column) -> Column:
    """The unit that ends a raw column name; NULL if the listed columns name none or several."""
    rx = rf"(?:^|[\s(\[])({unit_pattern(field)})[)\]]?$"
    units = F.transform(F.split(columns, ", "), lambda c: _unit_text(F.regexp_extract(F.trim(F.lower(c)), rx, 1)))
    units = F.array_distinct(F.filter(units, lambda u: u != ""))
    return F.when(F.size(units) == 1, F.element_at(units, 1))
