"""Truth tables of the column functions."""

import datetime as dt
import unicodedata

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from tablewright.functions import names, parse, text


def test_null_words_then_clean(apply):
    values = ["N/A", "none", "", "  ", " NA ", "a \t b", "NaN", "Null", "good", None, " n/a", "NA\n", "x \n y  "]
    got = apply(lambda c: text.clean(text.null_words(c)), values)
    assert apply(text.clean_input, values) == got
    assert got == [None, None, None, None, "NA", "a b", None, None, "good", None, "n/a", "NA", "x y"]


def test_every_space_python_strips_is_stripped(apply):
    spaces = [chr(i) for i in range(0x10000) if chr(i).isspace()]
    got = apply(text.clean, [f"{s}a{s}{s}b{s}" for s in spaces])
    assert set(got) == {"a b"}
    others = ["​", "﻿", "⁠", "᠎"]
    assert apply(text.strip, [f"{o}a" for o in others]) == [f"{o}a" for o in others]


def test_placeholders(apply):
    values = ["-", " -- ", "S/I", "Sin Información", "no_aplica", "n/a.", "—", "ok", "-x", " keep ", None]
    assert apply(text.placeholders, values) == [None] * 7 + ["ok", "-x", " keep ", None]
    assert apply(lambda c: text.placeholders(c, words=["foo"]), ["foo", " FOO ", "-"]) == [None, None, "-"]
    exact = lambda c: text.placeholders(c, key=c, words=["Foo"])
    assert apply(exact, ["foo", "Foo", " Foo"]) == ["foo", None, " Foo"]
    assert apply(lambda c: text.placeholders(c, words=[]), ["-", ""]) == ["-", ""]


def test_unicode_fold(apply):
    raw = ["a b", "“q” ‘s’", "x—y–z", "ﬁn ① Å", None, "plain"]
    got = apply(text.unicode_fold, raw)
    assert got == ["a b", "\"q\" 's'", "x-y-z", unicodedata.normalize("NFKC", "ﬁn ① Å"), None, "plain"]
    kept = apply(lambda c: text.unicode_fold(c, form="NFC", nbsp=False, quotes=False, dashes=False), raw[:3])
    assert kept == raw[:3]


def test_match_keys(apply):
    assert apply(text.match_key, [" Ab  C ", "", "  ", None]) == ["ab  c", None, None, None]
    assert apply(lambda c: text.match_key(c, collapse=True), [" Ab \t C "]) == ["ab c"]
    assert apply(lambda c: text.match_key(c, exact_casefold=True), ["STRASSE", "straße"]) == ["strasse"] * 2
    assert apply(lambda c: text.source_key("s", c.cast("long")), ["7", None]) == ["s:7", None]


def test_full_name_and_splits(spark):
    rows = [("Ana", "Paz"), ("Ana", None), (None, " Paz "), (None, None), ("", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(text.full_name(F.col("a"), F.col("b"))).collect()]
    assert got == ["Ana Paz", "Ana", "Paz", None, None]
    one = spark.createDataFrame([("a:b:c|d",)], "v string")
    assert one.select(text.split_tokens(F.col("v"))).first()[0] == ["a:b:c", "d"]
    before, after = text.split_once(F.col("v"))
    assert tuple(one.select(before, after).first()) == ("a", "b:c|d")


def test_parse_float(apply):
    cases = {
        "1.234,56": 1234.56, "12.345.678": 12345678.0, "1234.56": 1234.56, "1.234": 1.234, "12,5%": 0.125,
        "1 000": 1000.0, "1 000": 1000.0, "$5": None, "abc": None, "": None, "-3,5": -3.5, "5d": None,
        "5f": None, "NaN": None, "Infinity": None, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "1,2,3": None, "%": None,
        "50 %": 0.5, "1.5,2.5": 15.25, "+7": 7.0, "--7": None, None: None,
    }
    assert apply(parse.parse_float, list(cases)) == list(cases.values())
    english = lambda c: parse.parse_float(c, decimal=".", thousands=",")
    assert apply(english, ["1,234.56", "1,5", "10%"]) == [1234.56, 15.0, 0.1]
    plain = lambda c: parse.parse_float(c, decimal=".", thousands=None)
    assert apply(plain, ["1,234.56", "1.5"]) == [None, 1.5]


def test_parse_int(apply):
    cases = {
        "12 kg": 12, "12.0": 12, "1.234,00": 1234, "(5)": 5, "1e3": 13, "abc": None, "1.5": None, "1.234": None,
        "-4": -4, "4-": None, "": None, "nan": None, "9007199254740993": 9007199254740993,
        "99999999999999999999": None, "1.234.567": None, "1,5.3": None, ".0": 0, "1,00.0": 1, "$1.000,00": 1000, None: None,
        "1.234," + "0" * 900 + ".0": 1234, "1," + "x" * 900 + ".0": 1, "1.234\n,00": 1234, "1\n2": 12,
    }
    assert apply(parse.parse_int, list(cases)) == list(cases.values())
    assert apply(parse.is_fractional, ["1.5", "1.0", "x", None]) == [True, False, False, False]
    with pytest.raises(SparkRuntimeException, match="fractional"):
        apply(lambda c: parse.parse_int(c, strict=True), ["1", "1.5"])


def test_parse_bool(apply):
    yes, no, other = ["Sí", "si", "1", "T", " y ", "TRUE"], ["No", "0", "f", "n", "False"], ["yes", "1.0", "x", "", None]
    assert apply(parse.parse_bool, yes + no + other) == [True] * 6 + [False] * 5 + [None] * 5
    assert apply(lambda c: parse.bool_or_default(parse.parse_bool(c), True), ["x", "0"]) == [True, False]


def test_parse_date(apply):
    d = dt.datetime
    cases = {
        "2024-03-05": d(2024, 3, 5), "2024-03-05 10:00:00": d(2024, 3, 5, 10), "2024-03-05T10:00:01.5": d(2024, 3, 5, 10, 0, 1, 500000),
        "05/03/2024": d(2024, 3, 5), "5-3-2024": d(2024, 3, 5), "5.3.2024": d(2024, 3, 5), "5/3/24": d(2024, 3, 5),
        "5/3/70": d(1970, 3, 5), "05/03/2024 7:08": d(2024, 3, 5, 7, 8), "05/03/2024 07:08:09": d(2024, 3, 5, 7, 8, 9),
        "31/02/2024": None, "foo": None, "": None, " 05/03/2024 ": d(2024, 3, 5), "2024-02-30": None, "13/13/2024": None,
        "+2024-01-05 3": None, "+2024-1-5 ": None, "2024-01-05 7:08": d(2024, 1, 5, 7, 8), "2024-01-05  7:08": None,
        "2024": None, "5/3-2024": None, "5/3/024": None, "2024-03-05Z": None, None: None,
        "20240105": d(2024, 1, 5), "05-Jan-2024": d(2024, 1, 5), "5 sept 2024": d(2024, 9, 5), "05-Foo-2024": None,
        "2024/01/05": d(2024, 1, 5), "2024-1-5": d(2024, 1, 5), "2024.1.5 7:08": d(2024, 1, 5, 7, 8), "20241305": None,
        "2024-03-05T10:00:00Z": d(2024, 3, 5, 10), "2024-03-05T10:00:00+02:00": d(2024, 3, 5, 8), "12/25/2024": d(2024, 12, 25),
    }
    assert apply(parse.parse_date, list(cases)) == list(cases.values())
    us = lambda c: parse.parse_date(c, dayfirst=False)
    assert apply(us, ["03/05/2024", "2024-03-05", "13/05/2024", "25/12/2024", "31/02/2024"]) == [
        d(2024, 3, 5), d(2024, 3, 5), d(2024, 5, 13), d(2024, 12, 25), None,
    ]


TABLE_NAMES = {
    "DETALLE COMPRAS PRODUCTO": "compras_producto_items", "CAT_VEHICULOS": "vehiculos",
    "CATÁLOGO_VENTAS": "cat_logo_ventas".replace("cat_", "dim_", 1), "CAT_TIPOS_CLIENTES": "dim_tipos_cliente",
    "CAT_TIPOS_EGRESOS": "dim_tipos_egreso", "  Ventas -- 2024! ": "ventas_2024", "DETALLE_": "detalle", "x__y": "x_y",
}


def test_names(apply):
    assert {n: names.table_name(n) for n in TABLE_NAMES} == TABLE_NAMES
    assert apply(names.table_name_column, list(TABLE_NAMES)) == list(TABLE_NAMES.values())
    columns = {"activo": "is_active", "Column 7": "column_7", " Tipo (x) ": "tipo_x", "__a__": "a"}
    assert {n: names.column_name(n) for n in columns} == columns
    assert apply(names.column_name_column, list(columns)) == list(columns.values())


def test_names_that_meet_are_errors(text_frame):
    with pytest.raises(ValueError, match="both become"):
        names.rename_columns(text_frame(["a b", "a_b"]))
    one = text_frame("id")
    with pytest.raises(ValueError, match="both become"):
        names.rename_tables({"CAT_X": one, "dim_x": one})
    assert names.rename_columns(text_frame(["_ord", "Activo"])).columns == ["_ord", "is_active"]


def test_frame_forms(spark, text_frame):
    df = text_frame("id n d b", [("1", "1,5", "05/03/2024", "si")]).withColumn("k", F.lit(3))
    assert parse.parse_floats(df, ["n"]).first()["n"] == 1.5
    assert dict(parse.parse_floats(df).dtypes) == {"id": "double", "n": "double", "d": "double", "b": "double", "k": "int"}
    with pytest.raises(ValueError):
        parse.parse_floats(df, ["absent"])
    assert parse.parse_floats(df, ["absent", "n"], must_exist=False).first()["n"] == 1.5
    assert parse.parse_ints(df, ["id", "absent"]).first()["id"] == 1
    assert parse.parse_bools(df, ["b", "absent"]).first()["b"] is True
    assert parse.parse_dates(df, ["d"]).first()["d"] == dt.datetime(2024, 3, 5)
    with pytest.raises(ValueError):
        parse.parse_dates(df, ["absent"])
    padded = text_frame("a b", [(" x ", " y ")])
    assert tuple(text.clean_all(padded, ["a"]).first()) == ("x", " y ")
    assert tuple(text.clean_all(padded).first()) == ("x", "y")
    assert tuple(text.placeholders_all(padded, ["a", "absent"], words=["x"]).first()) == (None, " y ")
    assert tuple(text.unicode_fold_all(text_frame("a b", [("“", "”")]), ["a", "zz"]).first()) == ('"', "”")
    assert tuple(text.null_words_all(text_frame("a b", [("NA", "ok")])).first()) == (None, "ok")


def test_usual_values_take_the_short_way(spark, apply):
    """What the tests for plain values let through is what the whole chains would have given."""
    cases = {"1,250": 1.25, "-3": -3.0, "+7,5": 7.5, "1.005,50": 1005.5, "1,": 1.0, ",5": 0.5, "1 000": 1000.0, "50%": 0.5, "x": None, None: None}
    assert apply(parse.parse_float, list(cases)) == list(cases.values())
    assert apply(lambda c: parse.parse_int(c, strict=True), ["007", "-0", "1.000,0", "12 kg", "9" * 20, "", None]) == [7, 0, 1000, 12, None, None, None]
    values = ["N/A", "na.", "NULL", " nan ", "a  b", "a\tb", "a\u00a0", "\u0130", "nulls", "a b", "~", "", " ", None]
    assert apply(text.clean_input, values) == [None, "na.", None, "nan", "a b", "a b", "a", "\u0130", "nulls", "a b", "~", None, None, None]
    # plain values alone never meet the expressions for the rest: strict integers cost one test
    df = spark.createDataFrame([("1",)], "v string")
    plan = df.select(parse.parse_int(df["v"], strict=True))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index(parse._PLAIN_INT) < plan.index("raise_error")


def test_short_ways_of_plain_columns(spark, apply):
    """What a plain column may take instead of the whole chain gives the same, and none of it is interpreted."""
    dates = ["05/01/2024", "12/25/2024", "25/12/2024", "31/02/2024", "00/01/2024", "05/01/2024\n", " 05/01/2024", "5/1/2024", "05-01-2024",
             "2024-01-05", "2024-01-05T10:11:12", "2024-13-05", "05/01/24", "20240105", "05-Jan-2024", "", "x", None]
    for dayfirst in (True, False):
        whole = apply(lambda c: parse.parse_date(c, dayfirst), dates)
        assert apply(lambda c: parse.parse_date(c, dayfirst, plain=True), dates) == whole
    numbers = ["1", "007", "-3", "1,5", "1.5", "1.005,50", "12 kg", "50%", "1 000", "9" * 20, "+7", "", "x", None]
    for fn in (parse.parse_int, parse.parse_float):
        assert apply(lambda c: fn(c, plain=True), numbers) == apply(fn, numbers)
    padded = [" a b ", "  a", "a  b", "a  ", " nan", "nan ", "nan", "N/a", "n/a b", "\ta", "a\n", "é", "~", " ", "", None]
    assert apply(text.clean_input, padded) == apply(lambda c: text.clean(text.null_words(c)), padded)
    df = spark.createDataFrame([(" a", "1,5")], "v string, n string")
    plan = df.select(parse.parse_float(F.col("n"), plain=True), text.clean_input(F.col("v")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.index("RLIKE" if "RLIKE" in plan else "rlike") < plan.index("translate(")
