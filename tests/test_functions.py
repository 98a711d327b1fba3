import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from medley.functions import dates, nested, numbers, text, web
from medley.operators import aggregates, batches, commerce, project, reshape

DAY = dt.date(2024, 3, 1)


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_text(spark):
    c = F.col("s")
    got = values(spark, [("a,B",), ("x",), ("",), (None,)], "s string", text.part(c, ",", 0), text.part(c, ",", 1), text.swap_case(c))
    assert got == [("a", "B", "A,b"), ("x", None, "X"), ("", None, ""), (None, None, None)]
    got = values(spark, [(" a , b,",)], "s string", text.pieces(c, ","))
    assert got == [(["a", "b", ""],)]
    got = values(spark, [("1,234 ",), ("n/a",), (None,)], "s string", text.quoted_number(c))
    assert got == [(1234.0,), (None,), (None,)]
    assert values(spark, [("nan",), ("None",), ("ok",), ("NAN",)], "s string", text.null_token(c)) == [(None,), (None,), ("ok",), ("NAN",)]
    a, b = values(spark, [(" Ann ",), ("ann",)], "s string", text.stable_hash(c, "x"))
    assert a == b and values(spark, [(None,)], "s string", text.stable_hash(c)) == [(None,)]
    assert values(spark, [("a.b",)], "s string", text.part(c, ".", 1)) == [("b",)]


def test_dates(spark):
    c = F.col("s")
    rows = [("2020-02-30",), ("31/12/2020",), (None,)]
    assert values(spark, rows, "s string", dates.parse_date(c, "dd/MM/yyyy")) == [(None,), (dt.date(2020, 12, 31),), (None,)]
    got = values(spark, [("01/02/2020 10:30",)], "s string", dates.rewrite(c, "yyyy-MM-dd", "dd/MM/yyyy HH:mm", True))
    assert got == [("2020-02-01 10:30",)]
    got = values(spark, [("01/02/2020T10:30",)], "s string", dates.rewrite(c, "yyyy-MM-dd", "dd/MM/yyyyTHH:mm", True))
    assert got == [("2020-02-01T10:30",)]
    got = values(spark, [(dt.date(2000, 3, 1),), (dt.date(2024, 3, 1),)], "d date", dates.age_years(F.col("d"), DAY))
    assert got == [(24,), (0,)]
    low, high = dates.day_window(DAY, 1, 30)
    assert values(spark, [(1,)], "x int", low, high) == [(dt.date(2024, 2, 29), dt.date(2024, 3, 31))]
    lists = {"all": ["x"], "weekend": ["w"], "weekday": ["d"], "hourly": ["h"]}
    assert dates.scrape_lists(None, DAY, lists) == ["x"] and dates.scrape_lists("daily", DAY, lists) == ["d"]
    assert dates.scrape_lists("daily", dt.date(2024, 3, 2), lists) == ["w"] and dates.scrape_lists("hourly", DAY, lists) == ["h"]
    assert dates.region_zone("X", {"X": "EST"}) == "EST" and dates.region_zone("ASIA", {"X": "EST"}, "Europe/Amsterdam") == "Europe/Amsterdam"


def test_numbers(spark):
    x = F.col("x")
    got = values(spark, [(0.0,), (4.0,), (None,)], "x double", numbers.reciprocal(x), numbers.cap(x, 3.0))
    assert got == [(None, 0.0), (0.25, 3.0), (None, None)]
    assert values(spark, [(5,)], "x int", numbers.between_either(x, F.lit(7), F.lit(3))) == [(True,)]
    a, b = F.col("a"), F.col("b")
    ops = numbers.array_ops(a, b)
    got = values(spark, [([1.5, 4.0], [2.0, 0.0])], "a array<double>, b array<double>", *ops.values())
    assert got == [([3.5, 4.0], [0.75, None], [1, 4], [1.5, 4.0], [1.5, 4.0, 2.0, 0.0], [1.5, 4.0])]
    got = values(spark, [([3, 4, 6],)], "a array<int>", numbers.even_positions(a), numbers.even_values(a))
    assert got == [([1, 2], [4, 6])]
    merged = numbers.merge_maps(F.create_map(F.lit("k"), F.lit(1), F.lit("l"), F.lit(2)), F.create_map(F.lit("k"), F.lit(9)))
    assert values(spark, [(1,)], "x int", merged) == [({"l": 2, "k": 9},)]


def test_flatten(spark):
    schema = "id int, a struct<b: int, c: struct<d: string>>, xs array<struct<n: int, ys: array<string>>>"
    df = spark.createDataFrame([(1, (2, ("x",)), [(5, ["p", "q"]), (6, [])]), (2, None, None), (3, None, [])], schema)
    assert nested.flatten_structs(df).columns == ["id", "a_b", "a_c_d", "xs"]
    outer = [tuple(r) for r in nested.flatten(df, ["id"], "xs").collect()]
    assert outer == [(1, 0, 5, ["p", "q"]), (1, 1, 6, []), (2, None, None, None), (3, None, None, None)]
    inner = [tuple(r) for r in nested.flatten(df, ["id"], "xs.ys", outer=False).collect()]
    assert inner == [(1, 0, 0, "p"), (1, 0, 1, "q")]
    tables = commerce.child_tables(df, ["id"], {"xs": "xs", "a": "a", "none": "zz.y"})
    assert set(tables) == {"xs", "a"} and tables["a"].count() == 1


def test_json_keeps_going_on_bad_text(spark):
    rows = [('{"k": 1, "z": 2}',), ("{bad",), (None,)]
    assert values(spark, rows, "s string", nested.parse_json(F.col("s"), "k int")["k"]) == [(1,), (None,), (None,)]


def test_web(spark):
    good = '<script async type="application/ld+json" n="1">{"headline": "h", "interactionStatistic": [{"name": "likes", "userInteractionCount": "7"}]}</script>'
    df = spark.createDataFrame([(1, good), (2, "<p>none</p>"), (3, None)], "id int, html string")
    rows = {r["id"]: r for r in web.video_columns(df, "html", ["id"]).collect()}
    assert rows[1]["headline"] == "h" and rows[1]["likes"] == 7 and rows[1]["shares"] is None
    assert rows[2]["headline"] is None and rows[3]["headline"] is None
    meta = '<meta name="description" content="about us"><meta property="og:x" content="y">'
    got = values(spark, [(meta,)], "html string", web.meta_content(F.col("html"), "description"), web.meta_content(F.col("html"), "og:x"), web.title(F.col("html")))
    assert got == [("about us", "y", None)]


def test_udfs(spark, same):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "b", 5.0), (4, None, 2.0)], "id long, g string, v double")
    want = [(1, -1.0), (2, 1.0), (3, 0.0), (4, 0.0)]
    same(batches.demean(df, ["g"], "v", "off").select("id", "off"), want)

    def off(pdf):
        return pdf.assign(off=pdf.v - pdf.v.mean())[["id", "off"]]

    same(batches.grouped(df, ["g"], off, "id long, off double"), want)
    same(batches.map_batches(df.select("id"), lambda p: pd.DataFrame({"id": p.id * 2}), "id long"), [(2,), (4,), (6,), (8,)])
    left = spark.createDataFrame([(1, "x", 1.0), (3, "x", 2.0), (2, "y", 3.0)], "at long, id string, v double")
    right = spark.createDataFrame([(1, "x", "p"), (2, "x", "q")], "at long, id string, w string")
    got = batches.cogrouped_asof(left, right, "id", "at", "w")
    same(got, [(1, "x", 1.0, "p"), (3, "x", 2.0, "q"), (2, "y", 3.0, None)])


def test_projection(spark, same):
    df = spark.createDataFrame([(1, "a", None), (2, "nan", 4.0), (3, "b", 6.0)], "k int, s string, v double")
    same(project.fill_stat(df, "v", "mean").select("v"), [(5.0,), (4.0,), (6.0,)])
    same(project.fill_stat(df, "v", "median").select("v"), [(5.0,), (4.0,), (6.0,)])
    same(project.fill_stat(df, "v", "mode").select("v"), [(4.0,), (4.0,), (6.0,)])
    assert project.fill_stat(df.filter("k = 1"), "v", "median").first()["v"] is None
    with pytest.raises(ValueError):
        project.fill_stat(df, "v", "max")
    same(project.drop_above(df, "v", 5.0).select("k"), [(1,), (2,)])
    assert project.rename(df, ["x", "y", "z"]).columns == ["x", "y", "z"]
    assert project.sanitise_names(df.toDF("a b", "c%", "d")).columns == ["a_b", "c_", "d"]
    assert project.replace_column(df, "s", "t", F.lit(1)).columns == ["k", "v", "t"]
    assert project.row_ids(df).select("row_id").distinct().count() == 3
    stamped = project.stamp(df, DAY, dt.datetime(2024, 3, 1), "src").first()
    assert stamped["source_uri"] == "src" and stamped["report_date"] == DAY
    same(project.match_patterns(df, "s", [("any", "*"), ("n", "N*")], "r").select("k", "r"), [(1, "any"), (2, "any"), (2, "n"), (3, "any")])


def test_aggregates(spark, same):
    df = spark.createDataFrame([("a", 0.0), ("a", None)], "k string, v double")
    assert aggregates.ratio(df, "v", "v").first()["percent"] is None
    assert aggregates.watermark(df.limit(0), "v") is None
    row = aggregates.describe(df.filter("v is null"), "v").first()
    assert row["n"] == 0 and row["q2"] is None
    same(aggregates.profile(df), [("k", "string", 2), ("v", "double", 1)])
    same(aggregates.value_sets(df, ["k"], "v"), [("a", [0.0])])


def test_report_rows(spark, same):
    lines = [
        ("Assets", None), ("Current Assets", None), ("Cash", 10), ("", None), ("Total Current Assets", 10), (None, None),
        ("Other Assets", None), ("Land", 5), ("LIABILITIES", " "), ("Payables", ""), ("Wages", 3), ("Total", 3),
    ]
    for_file = [(f, i, a, None if b is None else str(b)) for f in ("x", "y") for i, (a, b) in enumerate(lines)]
    df = spark.createDataFrame([*for_file, ("z", 0, "Orphan", "4")], "file string, line int, label string, amount string")
    got = reshape.report_rows(df, "file", "line", "label", "amount").filter("file <> 'y'").drop("line")
    same(
        got,
        [
            ("x", "Assets", "Current Assets", "Cash", "10"),
            ("x", "Assets", "Other Assets", "Land", "5"),
            ("x", "LIABILITIES", "Payables", "Wages", "3"),
        ],
    )


def test_reshape(spark, same):
    df = spark.createDataFrame([("c1", 1, 2), ("c2", 3, 4)], "city string, d1 int, d2 int")
    same(reshape.melt(df, ["city"], ["d1", "d2"], "day", "n"), [("c1", "d1", 1), ("c1", "d2", 2), ("c2", "d1", 3), ("c2", "d2", 4)])
    same(reshape.transpose(df, "city", ["d1", "d2"], ["c1", "c2"]), [("d1", 1, 3), ("d2", 2, 4)])
    same(reshape.reindex(df, "city", ["c2", "c9"], "flag", 1, ["c9"]), [("c2", 3, 4, None), ("c9", None, None, 1)])
    copies = spark.createDataFrame([(2, "x"), (1, "x"), (3, None), (4, None)], "i int, t string")
    same(reshape.drop_duplicate_rows(copies, ["t"], "i"), [(1, "x"), (3, None)])
    ties = spark.createDataFrame([(1, "b"), (2, "a"), (2, "b"), (3, "b"), (3, "b")], "i int, t string")
    same(reshape.drop_duplicate_rows(ties, ["t"], "i"), [(1, "b"), (2, "a")])


def test_commerce(spark, same):
    lines = spark.createDataFrame([(1, 10.0, 2.0, False), (2, 10.0, 0.0, True), (None, 8.0, 2.0, True)], "p int, amount double, rate double, refund boolean")
    digital = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    got = commerce.sales_rows(lines, digital, "p", "amount", "rate", "refund").select("p", "amount_usd", "is_digital")
    same(got, [(1, 5.0, True), (2, None, False), (None, -4.0, False)])
    people = spark.createDataFrame([(" A@x ",), ("a@x",), (None,)], "mail string")
    assert commerce.reidentification(people, "mail", "s").count() == 1
    assert commerce.hash_emails(people, "mail").columns == ["mail_hash"]
    commerce_rows = commerce.repeat_customers(spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 2)], "c int, o int"), "c", "o")
    same(commerce_rows, [(2, 2)])


def test_rewrite_table(spark, tmp_path):
    for n in (3, 2):
        commerce.rewrite_table(spark.range(n), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
