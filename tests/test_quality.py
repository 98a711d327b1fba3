import datetime as dt

import pytest
from pyspark.sql import functions as F

from medley.operators.quality import Rule, gate, report, rules, select_rules, to_rules
from medley.operators.quality.dates import LocalFormat, normalise_dates
from medley.plans.quality import RULE_ROWS, RULE_SCHEMA, STRUCTURE_ROW

NOW = dt.datetime(2024, 3, 1, 6)
RULES = [
    Rule("null_check", "mandatory", ("a", "b"), "Null#Missing", "high", "g"),
    Rule("numeric_check", "numeric", ("n",), "Num#Not a number", "medium", "g"),
    Rule("date_check", "date", ("d",), "Date#Bad: date", "low", "g", "yyyy-MM-dd"),
    Rule("duplicate_check", "duplicate", ("a",), "Dup#Twice", "low", "h", "a,b"),
]
ROWS = [
    (1, "x", "p", "1.5", "2020-01-31"),
    (2, None, "p", "nan", "31/12/2020"),
    (3, "x", "p", "abc", "2020-13-01"),
    (4, " ", None, None, "01.02.2020"),
    (5, None, "q", "7", None),
    (6, None, "q", "8", "2020-01-01"),
]
SCHEMA = "id int, a string, b string, n string, d string"


@pytest.fixture(scope="module")
def done(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return gate(df, RULES, ["id"], "f.csv", [LocalFormat("dd/MM/yyyy")])


def texts(done):
    rows = done.tagged.select("id", "grade", report.render(F.col("errors")).alias("t")).collect()
    return {r["id"]: (r["grade"], r["t"]) for r in rows}


def test_tagging(done):
    got = texts(done)
    assert got[1] == ("low", "h-Dup#Twice: a")
    assert got[2] == ("high", "g-Null#Missing: a")
    assert got[3] == ("medium", "g-Num#Not a number: n;g-Date#Bad: date;h-Dup#Twice: a")
    assert got[4] == ("high", "g-Null#Missing: a;g-Null#Missing: b;g-Date#Bad: date")
    assert got[5] == ("high", "g-Null#Missing: a;h-Dup#Twice: a")
    assert got[6] == got[5]


def test_local_dates_are_rewritten_before_the_check(done):
    days = {r["id"]: r["d"] for r in done.tagged.select("id", "d").collect()}
    assert days[2] == "2020-12-31" and days[4] == "01-02-2020"


def test_split_keeps_every_row(done):
    assert done.valid.columns == ["id", "a", "b", "n", "d"]
    assert {r["id"] for r in done.valid.collect()} == {1}
    assert {r["id"] for r in done.held.collect()} == {2, 3, 4, 5, 6}
    assert done.valid.count() + done.held.count() == len(ROWS)
    assert done.invalid.count() == 6
    assert done.high_flag() is True


def test_reports(done, same):
    log = {r["rule"]: (r["error_text"], r["errors"], r["status"]) for r in done.log().collect()}
    assert log["null_check"] == ("Null#Missing: a,b", 5, "FALSE")
    assert log["numeric_check"] == ("Num#Not a number: n", 1, "FALSE")
    counts = {r["check"]: r["error_records"] for r in done.by_check().collect()}
    assert counts == {"numeric": 1, "date": 2, "duplicate": 4, "valid_value": 0, "mandatory": 5}
    rows = done.error_rows("f.csv", "job", NOW)
    assert rows.columns[-7:] == [
        "priority_level", "ERROR_DESCRIPTION", "FILENAME", "RECORD_NUMBER", "PROCESSED_DATE", "NOTEBOOK_NAME", "status"
    ]
    summary = report.summary(rows, 6, "XX", "SRC", "err", "err.csv", "/in")
    assert summary.agg(F.sum("count")).first()[0] == 6
    same(report.totals_by_file(summary), [(6, 1, 6)])
    same(report.mark_sent(summary, "f.csv").select("email_status").distinct(), [("sent",)])
    assert done.tagged.filter("id = 3").select(report.error_columns(F.col("errors"))).first()[0] == ["n", "d", "a"]


def test_materialised_result_is_the_same(done):
    assert texts(done.materialised()) == texts(done)


def test_export(done, spark, tmp_path):
    paths = report.export_by_grade(done.invalid, done.columns, done.key, str(tmp_path), "F.csv", "job", NOW)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["err_f_high", "err_f_medium", "err_f_low"]
    high = spark.read.option("header", True).csv(paths[0])
    assert high.count() == 1 + 3 + 2 + 2
    medium = report.export_frame(done.invalid, done.columns, done.key, "medium", "F.csv", "job", NOW)
    assert medium.count() == 3


def test_whole_row_duplicates_keep_the_first(spark):
    df = spark.createDataFrame([(3, "x", None), (1, "x", None), (2, "y", None), (4, None, None), (5, None, None)], "id int, a string, b string")
    rule = Rule("duplicate_check", "duplicate", ("a",), "Dup#Copy", "low", "g")
    got = gate(df, [rule], ["id"]).tagged.filter("grade <> 'ok'")
    assert {r["id"] for r in got.collect()} == {3, 5}


def test_identical_rows_are_duplicates_too(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b")], "id int, a string")
    rule = Rule("duplicate_check", "duplicate", ("a",), "Dup#Copy", "low", "g")
    grades = sorted((r["id"] or 0, r["grade"]) for r in gate(df, [rule], ["id"]).tagged.collect())
    assert grades == [(0, "low"), (0, "ok"), (1, "low"), (1, "low"), (1, "ok"), (2, "low")]


def test_custom_queries_neither_lose_nor_double_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, 9), (3, 9), (None, 9)], "id int, v int")
    sql = "SELECT d.*, 'C#big' AS processing_status_2, 'medium' AS priority_status_2 FROM {data} d, VALUES (1), (2) AS t(x) WHERE v > 5"
    done = gate(df, [Rule("custom_check", "custom", (), "", "low", "g", sql)], ["id"])
    assert sorted((r["id"] or 0, len(r["errors"])) for r in done.held.collect()) == [(0, 1), (2, 1), (3, 1), (3, 1)]
    assert [r["id"] for r in done.valid.collect()] == [1]


def test_export_takes_errors_apart_as_they_are(spark):
    df = spark.createDataFrame([(1, None, "x")], "id int, a string, b string")
    found = [
        Rule("null_check", "mandatory", ("a",), "Null#Missing; really", "high", "core-team"),
        Rule("valid_value_check", "valid_value", ("b",), "Value#Bad - or not", "low", "sales", "y"),
    ]
    done = gate(df, found, ["id"])
    lines = report.export_frame(done.invalid, done.columns, done.key, "high", "f.csv", "job", dt.datetime(2024, 1, 1)).collect()
    got = {(r["mail_group"], r["ERROR_DESCRIPTION"], r["priority_level"], r["RECORD_NUMBER"]) for r in lines}
    assert got == {("core-team", "Null#Missing; really: a", "high", "1"), ("sales", "Value#Bad - or not: b", "low", "1")}


def test_typed_dates_stay_dates(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2))], "id int, d date")
    done = gate(df, [Rule("date_check", "date", ("d",), "D#x", "low", "g", "yyyy-MM-dd")], ["id"])
    assert done.valid.schema["d"].dataType.simpleString() == "date" and done.valid.first()["d"] == dt.date(2024, 1, 2)


def test_rules_without_or_with_unknown_names_are_refused(spark):
    for name in (None, "no_such_check"):
        table = spark.createDataFrame([(name, *RULE_ROWS[0][1:])], RULE_SCHEMA)
        with pytest.raises(ValueError, match="unknown rules"):
            to_rules(table)


def test_text_that_reads_alike_is_not_a_duplicate(spark):
    df = spark.createDataFrame([(1, "a|1:b", "c"), (2, "a", "b|1:c"), (3, "n", None), (4, None, "n")], "id int, a string, b string")
    rule = Rule("duplicate_check", "duplicate", ("a",), "Dup#Copy", "low", "g")
    assert gate(df, [rule], ["id"]).invalid.count() == 0


def test_no_rules_and_empty_input(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert gate(df, [], ["id"]).valid.count() == len(ROWS)
    empty = gate(df.limit(0), RULES, ["id"])
    assert empty.valid.count() == 0 and empty.high_flag() is False
    assert {r["status"] for r in empty.log().collect()} == {"TRUE"}


def test_unknown_column_is_refused(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError):
        gate(df, [Rule("null_check", "mandatory", ("zz",), "N#x")], ["id"])


def test_null_outcome_of_an_expression_fails(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, v int")
    done = gate(df, [Rule("df_custom_check", "expr", ("v",), "C#low", "medium", "g", "{col} > 1")], ["id"])
    assert [r["id"] for r in done.held.collect()] == [2]


def test_custom_query_must_keep_the_columns(spark):
    df = spark.createDataFrame([(1, 5)], "id int, v int")
    bad = Rule("custom_check", "custom", (), "", "low", "g", "SELECT id FROM {data}")
    with pytest.raises(ValueError):
        gate(df, [bad], ["id"])


def test_rule_selection(spark):
    table = spark.createDataFrame(RULE_ROWS, RULE_SCHEMA)
    names = lambda *a: [r.name for r in to_rules(select_rules(table, *a))]
    assert names("XX", "orders", "ORDERS_2024.csv", "orders_*.csv") == ["null_check", "valid_value_check"]
    assert names("us", "ORDERS", "orders_1.csv", "orders_*.csv") == ["null_check", "numeric_check"]
    assert names("FR", "ORDERS", "orders_1.csv", "orders_*.csv") == []


def test_structure_check():
    assert rules.structure_check(["a", "b"], ["a", "b"])
    assert not rules.structure_check(["b", "a"], ["a", "b"])
    assert not rules.structure_check(["A", "b"], ["a", "b"])
    assert rules.structure_check(["A", "b"], ["a", "B"], ignore_case=True)


def test_local_format_order_and_scope(spark):
    df = spark.createDataFrame([("01.02.2020",), ("2020/03/04",), ("x",), (None,)], "d string")
    got = normalise_dates(df, ["d"], "yyyy-MM-dd", [LocalFormat("dd.MM.yyyy"), LocalFormat("MM.dd.yyyy")])
    assert [r[0] for r in got.collect()] == ["2020-02-01", "2020-03-04", "x", None]
    same = normalise_dates(df, ["d"], "yyyyMMdd", [])
    assert [r[0] for r in same.collect()] == ["01.02.2020", "2020/03/04", "x", None]
    assert not rules.local_format_applies("A", "sales", "orders.csv")
    assert rules.local_format_applies("A", "*", "orders.csv") and not rules.local_format_applies("I", "*", "orders.csv")


def test_error_table_upkeep(spark, same):
    day = lambda d: dt.datetime(2024, 3, d)
    old = spark.createDataFrame([("F.csv", day(1)), ("g.csv", day(1)), ("g.csv", dt.datetime(2024, 2, 26))], "FILENAME string, PROCESSED_DATE timestamp")
    new = spark.createDataFrame([("f.csv", day(1))], old.schema)
    got = report.refresh_error_table(old, new, "f.csv", dt.date(2024, 3, 1))
    same(got.select("FILENAME"), [("g.csv",), ("f.csv",)])


def test_file_run_keeps_the_books(spark, tmp_path):
    from medley.operators.load import read_files
    from medley.operators.quality.run import Delivery, HighPriorityError, StructureError, check_file, load_file

    table = spark.createDataFrame(RULE_ROWS, RULE_SCHEMA)
    errors, summary, out = (str(tmp_path / n) for n in ("errors", "summary", "out"))
    schema = "orderkey int, status string, segment string"
    good = spark.createDataFrame([(1, "O", "s"), (2, "Z", "s")], schema)
    bad = spark.createDataFrame([(1, None, "s"), (2, "O", "s")], schema)

    def run(df, file, hour):
        at = dt.datetime(2024, 3, 1, hour)
        delivery = Delivery(file, "orders_*.csv", "XX", "ORDERS", "job", at)
        return check_file(df, table, ["orderkey"], delivery, errors, summary, export=out)

    first = run(bad, "orders_2024.csv", 1)
    assert first.high_flag and first.error_path == errors
    with pytest.raises(HighPriorityError):
        load_file(first, good, ["orderkey"])
    run(bad, "orders_2024b.csv", 2)
    again = run(good, "orders_2024.csv", 3)
    assert not again.high_flag
    kept = {(r["FILENAME"], r["RECORD_NUMBER"], r["priority_level"]) for r in read_files(spark, errors).collect()}
    assert kept == {("orders_2024b.csv", "1", "high"), ("orders_2024.csv", "2", "low")}
    lines = {(r["filename"], r["count"], r["total_record"]) for r in read_files(spark, summary).collect()}
    assert lines == {("orders_2024b.csv", 1, 2), ("orders_2024.csv", 1, 2)}
    target = spark.createDataFrame([(2, "O", "t"), (9, "O", "t")], schema)
    merged = {tuple(r) for r in load_file(again, target, ["orderkey"]).collect()}
    assert merged == {(1, "O", "s"), (2, "Z", "s"), (9, "O", "t")}
    assert read_files(spark, str(tmp_path / "none")) is None
    run(bad, "ORDERS_2024.csv", 3)  # the same second as the run before, another spelling of its file
    run(bad, "orders_2024c.csv", 3)
    kept = sorted((r["FILENAME"], r["RECORD_NUMBER"]) for r in read_files(spark, errors).collect())
    assert kept == [("ORDERS_2024.csv", "1"), ("orders_2024b.csv", "1"), ("orders_2024c.csv", "1")]
    late = Delivery("orders_2024c.csv", "orders_*.csv", "XX", "ORDERS", "job", dt.datetime(2024, 3, 9))
    check_file(bad, table, ["orderkey"], late, errors, summary)  # days older than three go, so do the file's earlier rows
    assert [r["FILENAME"] for r in read_files(spark, errors).collect()] == ["orders_2024c.csv"]
    assert read_files(spark, summary).count() == 3
    strict = spark.createDataFrame([*RULE_ROWS, STRUCTURE_ROW], RULE_SCHEMA)
    with pytest.raises(StructureError):
        check_file(bad, strict, ["orderkey"], late, errors, summary, expected=["orderkey"])
    passed = run(good, "other.txt", 4)
    assert passed.result is None and passed.valid is good
