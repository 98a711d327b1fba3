import datetime as dt


from medley.operators import joins

D = dt.date


def ranges(spark):
    rows = [("a", 1.0, D(2024, 1, 1), D(2024, 1, 10)), ("a", 2.0, D(2024, 1, 10), D(2024, 3, 5)),
            ("b", 3.0, D(2023, 1, 1), D(9999, 12, 31)), ("c", 4.0, D(2024, 2, 1), D(2024, 1, 1))]
    return spark.createDataFrame(rows, "key string, rate double, s date, e date")


def left(spark):
    at = lambda *a: dt.datetime(*a)
    rows = [(1, "a", at(2024, 1, 1)), (2, "a", at(2024, 1, 10, 23)), (3, "a", at(2024, 3, 6)), (4, "b", at(2024, 2, 2)),
            (5, "c", at(2024, 1, 15)), (6, None, at(2024, 1, 1)), (7, "a", None)]
    return spark.createDataFrame(rows, "id int, cur string, at timestamp")


def test_interval_join(spark, same):
    got = joins.interval_join(left(spark), ranges(spark), ("cur", "key"), "at", "s", "e")
    want = [(1, 1.0), (2, 1.0), (2, 2.0), (3, None), (4, 3.0), (5, None), (6, None), (7, None)]
    same(got.select("id", "rate"), want)


def test_interval_join_of_a_hot_day(spark, same):
    rows = [(i, "a", dt.datetime(2024, 1, 10)) for i in range(300)] + [(300, "a", dt.datetime(2024, 1, 9)), (301, "z", None)]
    df = spark.createDataFrame(rows, "id int, cur string, at timestamp")
    for how, extra in (("left", [(301, None)]), ("inner", [])):
        got = joins.interval_join(df, ranges(spark), ("cur", "key"), "at", "s", "e", how)
        same(got.select("id", "rate"), [(i, r) for i in range(300) for r in (1.0, 2.0)] + [(300, 1.0)] + extra)


def test_interval_join_plan_has_no_pairs_of_rows(spark):
    df = joins.interval_join(left(spark), ranges(spark), ("cur", "key"), "at", "s", "e")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the one nested loop is with the single row of first and last day
    assert plan.count("NestedLoop") == 1 and "Cartesian" not in plan and plan.count("collect_list") == 0


def test_interval_join_without_rows(spark):
    empty = left(spark).limit(0)
    assert joins.interval_join(empty, ranges(spark), ("cur", "key"), "at", "s", "e").count() == 0


def test_overlapping(spark, same):
    got = joins.overlapping(ranges(spark), "key", "s", "e").select("key", "rate")
    same(got, [("a", 2.0)])


def test_anti_and_semi_with_nulls(spark, same):
    a = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (None,), (2,)], "k int")
    same(joins.anti(a, b, ["k"]), [(1,), (None,)])
    same(joins.semi(a, b, ["k"]), [(2,), (2,)])
    only_a, only_b = joins.differences(a, b, "k")
    same(only_a, [(1,)])
    same(only_b, [])


def test_requests(spark, same):
    shops = spark.createDataFrame([("S1",), ("s2",), ("s2",), ("s3",)], "shop string")
    idle = spark.createDataFrame([("s3",)], "shop string")
    apis = [("orders", "https://{shop_domain}/o?d={day}")]
    got = joins.requests(shops, "shop", apis, {"day": D(2024, 1, 2)}, idle)
    same(got, [("S1", "orders", "https://S1/o?d=2024-01-02"), ("s2", "orders", "https://s2/o?d=2024-01-02")])
    assert joins.requests(shops, "shop", apis, {}, only="s1").count() == 1


def test_enrich_flags_misses(spark, same):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1, "x")], "k int, name string")
    same(joins.enrich(a, b, ["k"]), [(1, "x", False), (2, None, True), (None, None, True)])


def test_compare_totals_with_an_empty_side(spark, same):
    a = spark.range(3)
    same(joins.compare_totals(a, spark.range(0)), [(3, 0, False)])
    same(joins.compare_totals(spark.range(0), spark.range(0)), [(0, 0, True)])
