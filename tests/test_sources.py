import datetime as dt

import pytest

from medley.sources import files, jdbc, landing, typed

DAY = dt.date(2024, 1, 2)


def test_csv_and_single_files(spark, tmp_path, same):
    df = files.frame_from(spark, [(1, "a,b"), (2, None)], "k int, v string")
    files.write_csv(df, str(tmp_path / "c"))
    same(files.read_csv(spark, str(tmp_path / "c"), "k int, v string"), [(1, "a,b"), (2, None)])
    files.write_single_file(df.repartition(4), str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1
    files.write_quoted(df, str(tmp_path / "q"))
    text = sorted(line for f in (tmp_path / "q").glob("*.csv") for line in f.read_text().splitlines())
    assert '"1","a,b"' in text and '"2",""' in text
    path = files.export_csv_dated(df, str(tmp_path / "out_"), DAY)
    assert path.endswith("out_20240102") and files.read_csv(spark, path).count() == 2


def test_formats(spark, tmp_path):
    df = spark.range(100)
    files.write_n_files(df, str(tmp_path / "n"), 3)
    assert len(list((tmp_path / "n").glob("*.parquet"))) == 3
    files.write_table(df, str(tmp_path / "o"), "orc")
    assert files.read_table(spark, str(tmp_path / "o"), "orc").count() == 100
    (tmp_path / "m.json").write_text('[{"a": 1,\n "b": 2},\n {"a": 3}]')
    assert files.read_json_multiline(spark, str(tmp_path / "m.json"), "a int").count() == 2
    files.export_ndjson(df, str(tmp_path / "j"))
    assert files.read_json_lines(spark, str(tmp_path / "j"), "id long").count() == 100
    files.archive_by_date(df, str(tmp_path / "a"), DAY)
    files.archive_by_date(df, str(tmp_path / "a"), DAY)
    assert (tmp_path / "a" / "Year=2024" / "Month=1" / "Day=2").exists()
    assert spark.read.parquet(str(tmp_path / "a")).count() == 100
    files.register_view(df, "hundred")
    assert spark.sql("select count(*) from hundred").first()[0] == 100


def test_partitions_have_few_files_and_a_hot_value_several(spark, tmp_path):
    df = spark.range(200_000).repartition(16).selectExpr("id", "if(id % 3 = 0, id, 0) % 5 as p")
    files.write_partitioned(df, str(tmp_path / "p"), ["p"])
    assert len(list((tmp_path / "p").glob("p=*/*.parquet"))) <= 12
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")  # as if the rows were many
    files.write_partitioned(df, str(tmp_path / "q"), ["p"])
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "q" / "p=0").glob("*.parquet"))) > 4
    assert spark.read.parquet(str(tmp_path / "q")).count() == 200_000


def test_landing(spark, tmp_path, same):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "x.json").write_text('{"a": 1, "zz": 9}\n{"b": "t"}\n')
    table = str(tmp_path / "table")
    for _ in range(2):
        landing.load_ndjson(spark, str(raw), "a int, b string", DAY, table)
    same(spark.read.parquet(table).select("a", "b"), [(1, None), (None, "t")])
    landing.load_ndjson_append(spark, str(raw), "a int, b string", DAY, table)
    assert spark.read.parquet(table).count() == 4
    (raw / "y.json").write_text("{bad\n" * 3)
    assert landing.load_tolerant(spark, str(raw), "a int, b string", 3).count() == 2
    with pytest.raises(ValueError):
        landing.load_tolerant(spark, str(raw), "a int, b string", 2)


def test_listing(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    assert landing.read_if_any(spark, str(folder), "a int").count() == 0
    assert landing.read_if_any(spark, str(tmp_path / "none"), "a int").columns == ["a"]
    for n in "ab":
        (folder / f"{n}.json").write_text('{"a": 1}\n')
    assert landing.read_if_any(spark, str(folder), "a int").count() == 2
    listed = landing.list_files(spark, str(folder))
    log = listed.filter("file_name like '%a.json'").select("file_name")
    left = landing.unprocessed(listed, log).collect()
    assert [r["file_name"].rsplit("/", 1)[1] for r in left] == ["b.json"]


def test_tables(spark):
    for _ in range(2):
        landing.create_table_if_missing(spark, "made", "a int, day date", ["day"])
    assert spark.table("made").count() == 0
    spark.range(1).createOrReplaceTempView("staging_x")
    landing.drop_staging(spark, "staging_x")
    landing.drop_staging(spark, "made")
    assert not spark.catalog.tableExists("made") and not spark.catalog.tableExists("staging_x")


def test_typed(spark, tmp_path):
    fields = [("id", "int"), ("ok", "boolean"), ("x", "double"), ("s", "string")]
    with pytest.raises(ValueError):
        typed.check_fields([("d", "date")])
    (tmp_path / "t.txt").write_text("1|true|2.5|a\n2|false||b\n")
    used = typed.csv_to_typed(spark, str(tmp_path / "t.txt"), str(tmp_path / "o"), fields, "|", strict=False)
    rows = sorted(tuple(r) for r in typed.read_typed(spark, str(tmp_path / "o"), used).collect())
    assert rows == [(1, True, 2.5, "a"), (2, False, None, "b")]
    lines = spark.createDataFrame([("x|true|1|a",)], "value string")
    with pytest.raises(Exception):
        typed.parse_typed(lines, fields, "|").collect()


def test_routing(spark, tmp_path):
    df = spark.createDataFrame([("error", "a"), ("error", "a"), ("report", "b"), ("s1", "c"), (None, "d")], "k string, v string")
    landing.route_by_key(df, "k", str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r" / "error")).count() == 1
    assert spark.read.json(str(tmp_path / "r" / "data")).count() == 2


def test_jdbc_options():
    o = jdbc.read_options("jdbc:x", "select 1", "id", 0, 100, 4)
    assert o["dbtable"] == "(select 1) q" and o["numPartitions"] == "4" and o["partitionColumn"] == "id"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "select 1")
    assert jdbc.write_options("jdbc:x", "t")["dbtable"] == "t"


def test_intermediate_tables_can_be_cleared(spark):
    from pathlib import Path

    from medley import session

    kept = session.materialise(spark.range(3), "three")
    assert kept.count() == 3
    path = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    assert path.exists() and session.clear(spark) >= 1 and not path.exists()
