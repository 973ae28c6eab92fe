"""Scalar functions against values worked out by hand, with nulls and edges."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skeinwork.errors import Unsupported
from skeinwork.functions import dates as D
from skeinwork.functions import jsons as J
from skeinwork.functions import logic as L
from skeinwork.functions import maths as M
from skeinwork.functions import strings as S

lit = F.lit


def ts(text):
    return lit(text).cast("timestamp_ntz")


def cases():
    NULL = lit(None).cast("string")
    return {
        "blank spaces": (S.is_null_or_blank(lit("  ")), True),
        "blank tab": (S.is_null_or_blank(lit("\t")), False),
        "starts with null": (S.starts_with(NULL, lit("a")), False),
        "ends with null part": (S.ends_with(lit("a"), NULL), False),
        "contains null": (S.contains(NULL, lit("a")), None),
        "substring": (S.substring(lit("Goodbye"), 4), "bye"),
        "substring multibyte": (S.substring(lit("aé日b"), 1, 2), "é日"),
        "replace": (S.replace(lit("Goodbye"), lit("Good"), lit("See you ")), "See you bye"),
        "length": (S.length(lit("Goodbye")), 7),
        "trim": (S.trim(lit("  Hello World  ")), "Hello World"),
        "trim set": (S.trim(lit("xyaxy"), "yx"), "a"),
        "trim empty set": (S.trim_end(lit("a "), ""), "a"),
        "index": (S.index_of(lit("abcabc"), lit("c"), 3), 5),
        "index absent": (S.index_of(lit("abc"), lit("z")), -1),
        "pad cuts": (S.pad_left(lit("abcdef"), 3), "abc"),
        "plus null": (S.plus(lit("a"), NULL), "a"),
        "concat null": (S.concat(lit("a"), NULL), None),
        "join null": (S.join(",", lit("a"), NULL, lit("b")), "a,,b"),
        "regex empty": (S.matches(lit("x"), lit("")), True),
        "regex digits": (S.matches(lit("abc123"), lit("[0-9]+")), True),
        "bool null": (S.bool_text(lit(None).cast("boolean")), ""),
        "byte 255": (S.byte_at(F.unhex(lit("00FF7F")), 1), 255),
        "byte outside": (S.byte_at(F.unhex(lit("00")), 3), None),
        "bytes contain 255": (S.bytes_contain(F.unhex(lit("00FF")), lit(255)), True),
        "bytes lack 7": (S.bytes_contain(F.unhex(lit("00FF")), lit(7)), False),
        "guid": (S.guid_text(S.guid_from_text(lit("00112233-4455-6677-8899-AABBCCDDEEFF"))), "00112233-4455-6677-8899-aabbccddeeff"),
        "boolean mode": (S.match_boolean(lit("The quick brown fox"), '+quick -dog "brown fox"'), True),
        "boolean mode excluded": (S.match_boolean(lit("The quick dog"), "+quick -dog"), False),
        "boolean mode optional": (S.match_boolean(lit("a cat"), "dog fish"), False),
        "natural": (S.match_natural(lit("Fox, and hound"), "HOUND cat"), True),
        "greatest null": (L.greatest(lit(1), lit(None).cast("int")), None),
        "divide zero": (L.divide(lit(1.0), lit(0.0)), None),
        "div zero": (L.divide_integers(lit(7).cast("long"), lit(0).cast("long")), None),
        "div negative": (L.divide_integers(lit(-7).cast("long"), lit(2).cast("long")), -3),
        "eq nulls": (L.eq_objects(NULL, NULL), True),
        "json equal": (L.json_equal(lit('{"a":1,"b":2}'), lit('{ "b": 2, "a": 1 }')), True),
        "decimal": (L.to_decimal(lit(0.1)), Decimal("0.1").quantize(Decimal(10) ** -18)),
        "array null item": (L.array_has(F.array(lit(1), lit(None)), lit(None).cast("int")), True),
        "flag": (L.has_flag(lit(6), 4), True),
        "acos outside": (M.acos(lit(2.0)), None),
        "sqrt negative": (M.sqrt(lit(-1.0)), None),
        "ln zero": (M.log(lit(0.0)), None),
        "log base": (M.rounded(M.log(lit(8.0), lit(2.0)), 9), 3.0),
        "atanh edge": (M.atanh(lit(1.0)), None),
        "ceiling": (M.ceiling(lit(-16.7)), -16),
        "floor": (M.floor(lit(-16.7)), -17),
        "round half": (M.rounded(lit(-2.5)), -3.0),
        "truncate": (M.truncate(lit(-16.7)), -16.0),
        "sign": (M.sign(lit(-2.0)), -1),
        "month end": (D.add(ts("2024-01-31"), "MONTH", 1), dt.datetime(2024, 2, 29)),
        "leap year": (D.add(ts("2024-02-29"), "YEAR", 1), dt.datetime(2025, 2, 28)),
        "millisecond": (D.millisecond(ts("2024-01-01 00:00:00.987654")), 987),
        "microsecond": (D.microsecond(ts("2024-01-01 00:00:00.987654")), 654),
        "day number": (D.day_number(lit("0001-01-01").cast("date")), 0),
        "sunday": (D.day_of_week(lit("2024-03-03").cast("date")), 0),
        "ticks": (D.difference(ts("2024-01-01 00:00:01"), ts("2024-01-01")), 10_000_000),
        "parse": (D.parse(lit("3/14/2021 09:26:53")), dt.datetime(2021, 3, 14, 9, 26, 53)),
        "parse bad": (D.parse(lit("x")), None),
        "wrap": (D.time_add_hours(D.time(23), lit(2)), 3_600_000_000),
        "wrap back": (D.time_add(D.time(0), lit(-10).cast("long")), D.DAY - 1),
        "night": (D.time_between(D.time(23), D.time(22), D.time(6)), True),
        "day": (D.time_between(D.time(6), D.time(22), D.time(6)), False),
        "span days": (D.span_part(lit(-864_000_000_001).cast("long"), "days"), -1),
        "span ns": (D.span_part(lit(-7).cast("long"), "nanoseconds"), -700),
        "offset minus": (D.offset_minus(lit("2024-01-01 00:00:00.0000000+14:00"), lit(1).cast("long")), "2023-12-31 23:59:59.9999999+14:00"),
        "offset unix": (D.offset_unix_seconds(lit("1970-01-01 14:00:00.0000000+14:00")), 0),
        "json length": (J.length(lit('{"a":1,"b":{"c":2}}')), 2),
        "json depth": (J.doc_depth(lit('{"a":1,"b":{"c":2}}')), 3),
        "json null leaf": (J.value(lit('{"a":null}'), "$.a"), None),
        "json null text": (J.value(lit('{"a":"null"}'), "$.a"), "null"),
        "json quoted": (J.value(lit('{"a b":{"c.d":5}}'), '$."a b"."c.d"', "int"), 5),
        "json bytes": (J.value(lit('{"a":"AP8="}'), "$.a", "binary"), bytearray(b"\x00\xff")),
        "json type": (J.type_name(lit("1.5")), "DOUBLE"),
        "json type array": (J.type_name(lit("[]")), "ARRAY"),
        "json set new": (J.set_value(lit('{"a":1.10}'), "$.b", lit("x")), '{"a": 1.10, "b": "x"}'),
        "json set append": (J.set_value(lit("[1]"), "$[5]", lit(2)), "[1, 2]"),
        "json replace absent": (J.replace_value(lit('{"a":1}'), "$.b", lit(2)), '{"a": 1}'),
        "json remove": (J.remove_value(lit('{"a":[1,2]}'), "$.a[0]"), '{"a": [2]}'),
        "json contains": (J.contains(lit('{"a":[1,{"b":2}],"c":3}'), lit('{"a":[{"b":2}]}')), True),
        "json contains bool": (J.contains(lit("[1]"), lit("true")), False),
        "json edit null": (J.set_value(NULL, "$.a", lit(1)), None),
        "guid nulls": (S.guid_text(lit(None).cast("binary")), None),
    }


def test_cases(spark):
    expected = cases()
    row = spark.range(1).select(*(column.alias(name) for name, (column, _) in expected.items())).first()
    assert row.asDict() == {name: value for name, (_, value) in expected.items()}


MASKS = {"int": (31, 32), "uint": (31, 32), "long": (63, 64), "ulong": (63, 64)}


@pytest.mark.parametrize("kind,value", [("int", -8), ("int", 8), ("int", 2**31 - 1), ("long", -8), ("long", 1), ("long", 2**63 - 1), ("uint", 2**31), ("uint", 2**32 - 1), ("ulong", 2**63), ("ulong", 2**64 - 1), ("ulong", 1)])
def test_shifts(spark, kind, value):
    """Counts are masked to the width; signed values wrap and shift arithmetically, unsigned ones logically."""
    mask, width = MASKS[kind]
    stored = lit(str(value)).cast("decimal(20,0)") if kind == "ulong" else lit(value).cast("int" if kind == "int" else "long")
    for count in (-1, 0, 1, 31, 32, 33, 63, 64):
        by = count & mask
        left, right = (value << by) % 2**width, (value >> by)
        if kind in ("int", "long") and left >= 2 ** (width - 1):
            left -= 2**width
        row = spark.range(1).select(L.shift_left(stored, lit(count), kind).alias("l"), L.shift_right(stored, lit(count), kind).alias("r")).first()
        assert (int(row.l), int(row.r)) == (left, right), count


def test_unsupported():
    for call in (lambda: L.compare_with_culture("a"), lambda: L.collate(lit("a"), "x; drop"), lambda: J.parse_path("a"), lambda: J.parse_path("$[x]"), lambda: L.shift_left(lit(1), lit(1), "byte"), lambda: J.edit({}, [], "remove")):
        with pytest.raises(Unsupported):
            call()


@given(st.lists(st.one_of(st.integers(0, 99), st.text(st.characters(codec="utf-8", exclude_characters="\x00"), min_size=1, max_size=6)), max_size=5))
def test_paths_round_trip(steps):
    assert J.parse_path(J.build_path(*steps)) == steps


_JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=4), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8)


@given(_JSON)
def test_json_text_round_trip(doc):
    assert J.load(J.dump(doc)) == doc
    assert J.contained(doc, doc)


@given(st.text(max_size=30))
def test_boolean_parser_ends(query):
    assert all(text for _, text, _, _ in S.parse_boolean(query))
