from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from landroll.functions.address import compose, make_point, match_address_raw, normalize_address, point_ewkt
from landroll.functions.cast import ColumnSpec, typed_cast


def test_compose_collapses_and_skips_nulls(spark):
    df = spark.createDataFrame([(" 12 ", None, "Main\t\tSt", "", "  N  ")], "a string, b string, c string, d string, e string")
    assert df.select(compose("a", "b", "c", "d", "e")).first()[0] == "12 Main St N"
    assert df.select(match_address_raw("a", "b", "d")).first()[0] == " 12   "  # no collapsing, NULL -> ''


def test_normalize_address(spark):
    df = spark.createDataFrame([("123 North Main Street, Apt. #4",), ("  Caf\xe9  Boulevard ",), ("",)], "s string")
    got = [r[0] for r in df.select(normalize_address("s")).collect()]
    assert got == ["123 N MAIN ST APT 4", "CAFE BLVD", ""]


def test_make_point(spark):
    df = spark.createDataFrame([(Decimal("-111.5"), Decimal("40.25")), (None, Decimal("1"))],
                               "lon decimal(10,6), lat decimal(10,6)")
    pts = df.select(make_point("lon", "lat").alias("p")).select("p", point_ewkt("p").alias("w")).collect()
    assert (pts[0].p.lon, pts[0].p.lat, pts[0].p.srid) == (-111.5, 40.25, 4326)
    assert pts[0].w == "SRID=4326;POINT(-111.5 40.25)"
    assert pts[1].p is None and pts[1].w is None


def test_bool_spellings(spark):
    words = ["t", "f", "Y", "N", "1", "0", "true", "no", "on", "OFF", " yes ", "maybe", "  ", "", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    typed, _ = typed_cast(df, [ColumnSpec("w", "bool")], keep=["i"])
    got = typed.orderBy("i").collect()
    assert [r.w for r in got] == [True, False, True, False, True, False, True, False, True, False, True] + [None] * 4
    # Only the empty field and NULL are no value; blanks alone are a bad one.
    assert [len(r._problems) for r in got] == [0] * 11 + [1, 1, 0, 0]


def test_blank_and_length_rules(spark):
    specs = [ColumnSpec("n", "int"), ColumnSpec("d", "date"), ColumnSpec("c", "char", length=2),
             ColumnSpec("v", "string", length=3), ColumnSpec("f", "string", length=3)]
    rows = [(1, "  ", " ", "  ", "abc   ", "  "), (2, "", "", "", "abc x", ""), (3, None, None, None, "ab ", None)]
    df = spark.createDataFrame(rows, "i int, n string, d string, c string, v string, f string")
    typed, _ = typed_cast(df, specs, forced=["f"], keep=["i"])
    a, b, c = typed.orderBy("i").collect()
    assert sorted(a._problems) == ["d:type", "n:type"] and a.c == "  " and a.v == "abc" and a.f == "  "
    assert b._problems == ["v:length"] and b.n is None and b.f == ""
    assert c._problems == [] and c.v == "ab " and c.f == ""


def test_typed_cast_reports_problems(spark):
    specs = [ColumnSpec("k", "long"), ColumnSpec("d", "decimal", precision=10, scale=6),
             ColumnSpec("s", "short"), ColumnSpec("b", "bool"), ColumnSpec("t", "string", length=3),
             ColumnSpec("f", "string"), ColumnSpec("dt", "date")]
    rows = [("1", "123.4567894", "7", "Y", "abc", None, "2019-04-29"),
            ("2", "12345.1234567", "40000", "maybe", "abcd", "", "04/29/2019"),
            ("", "1", "1", "t", "a", "x", "junk")]
    df = spark.createDataFrame(rows, ", ".join(f"{s.name} string" for s in specs))
    typed, _ = typed_cast(df, specs, forced=["f"], required=["k"])
    out = typed.orderBy(F.col("k").asc_nulls_last()).collect()
    assert out[0].d == Decimal("123.456789") and out[0].b is True and out[0].f == "" and out[0]._problems == []
    assert str(out[0].dt) == "2019-04-29" and str(out[1].dt) == "2019-04-29"
    assert sorted(out[1]._problems) == ["b:type", "d:type", "s:type", "t:length"]
    assert sorted(out[2]._problems) == ["dt:type", "k:required"]


def test_standardize_batches_runs_per_arrow_batch(spark):
    from landroll.operators.enrich import standardize_batches

    def upper_streets(pdf):
        return pdf.assign(delivery_line_1=pdf["street"].str.upper().str.strip())

    df = spark.createDataFrame([(1, " 12 main st "), (2, "9 elm")], "admid long, street string").repartition(2)
    out = standardize_batches(df, upper_streets, "admid long, street string, delivery_line_1 string")
    assert sorted((r.admid, r.delivery_line_1) for r in out.collect()) == [(1, "12 MAIN ST"), (2, "9 ELM")]
