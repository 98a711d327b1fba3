import datetime as dt
import json

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from medley.streaming import entities
from medley.streaming.entities import Entity

BASE = dt.datetime(2024, 1, 1)
KINDS = [Entity("orders", ["id"], "updated_at"), Entity("levels", ["item", "place"], "at")]


def land(folder, name, number, rows):
    place = folder / "in" / f"entity={name}"
    place.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in rows]
    (place / f"{number:03d}.json").write_text("\n".join(lines) + "\n")


def order(i, hours, extra=0):
    return {"id": i, "updated_at": str(BASE + dt.timedelta(hours=hours)), "extra": extra}


@pytest.fixture
def load(spark, tmp_path):
    def run(checkpoint="cp"):
        stream = entities.read_landing(spark, str(tmp_path / "in"), KINDS)
        query = entities.load_entities(stream, str(tmp_path / "out"), str(tmp_path / checkpoint), "1 day", buckets=3)
        query.awaitTermination()
        return query

    return run


def keys(spark, tmp_path, kind):
    rows = entities.read_loaded(spark, str(tmp_path / "out"), kind)
    return sorted((r.entity, r.key, str(r.event_date)) for r in rows.collect())


def test_each_key_once_late_aside_over_restarts(spark, tmp_path, load):
    land(tmp_path, "orders", 1, [order(1, 0), order(1, 0), order(2, 30), "no json", {"id": None, "updated_at": "2024-01-01 00:00:00"}])
    land(tmp_path, "levels", 1, [{"item": 1, "place": "a", "at": "2024-01-01 05:00:00"}, {"item": 1, "place": "b", "at": "2024-01-01 05:00:00"}])
    load()
    # the watermark is now at 06:00 of the first day; the first two rows are repeats, one in time and one late
    land(tmp_path, "orders", 2, [order(2, 30), order(1, 0), order(3, 7), order(4, 1), order(5, 100)])
    load()
    assert keys(spark, tmp_path, "loaded") == [
        ("levels", '["1","a"]', "2024-01-01"), ("levels", '["1","b"]', "2024-01-01"), ("orders", '["1"]', "2024-01-01"),
        ("orders", '["2"]', "2024-01-02"), ("orders", '["3"]', "2024-01-01"), ("orders", '["5"]', "2024-01-05"),
    ]
    assert keys(spark, tmp_path, "late") == [("orders", '["1"]', "2024-01-01"), ("orders", '["4"]', "2024-01-01")]
    bad = entities.read_loaded(spark, str(tmp_path / "out"), "bad")
    assert bad.count() == 2 and bad.filter("value = 'no json'").count() == 1
    whole = entities.with_late(spark, str(tmp_path / "out"))
    assert whole.count() == 7 and whole.filter("key = '[\"4\"]'").count() == 1 and whole.select("entity", "key").distinct().count() == 7
    # the clock has left the first two days: their keys are cleared, and a repeat is late and not loaded again
    land(tmp_path, "orders", 3, [order(2, 30), order(6, 101)])
    load()
    assert ("orders", '["2"]', "2024-01-02") in keys(spark, tmp_path, "late")
    assert len(keys(spark, tmp_path, "loaded")) == 7


def test_state_holds_only_dates_the_watermark_has_not_left(spark, tmp_path, load):
    held = []
    for day in range(4):
        land(tmp_path, "orders", day, [order(100 * day + i, 24 * day + i % 24) for i in range(50)])
        query = load()
        held.append(max(s["stateOperators"][0]["numRowsTotal"] for s in [json.loads(p.json) for p in query.recentProgress] if s["stateOperators"]))
    assert keys(spark, tmp_path, "late") == [] and len(keys(spark, tmp_path, "loaded")) == 200
    assert max(held) <= 200 and held[-1] <= held[1] + 60


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path, load):
    land(tmp_path, "orders", 1, [order(i, i) for i in range(20)])
    load()
    before = keys(spark, tmp_path, "loaded")
    commits = tmp_path / "cp" / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink()  # as if the process had been lost between the write and the commit
    load()
    assert keys(spark, tmp_path, "loaded") == before


def test_the_session_need_not_name_a_state_store(spark, tmp_path, load):
    before = spark.conf.get(entities.PROVIDER)
    spark.conf.set(entities.PROVIDER, entities.PLAIN)
    try:
        land(tmp_path, "orders", 1, [order(1, 0), order(1, 0), order(2, 30)])
        load()
        assert spark.conf.get(entities.PROVIDER) == entities.PLAIN
    finally:
        spark.conf.set(entities.PROVIDER, before)
    assert keys(spark, tmp_path, "loaded") == [("orders", '["1"]', "2024-01-01"), ("orders", '["2"]', "2024-01-02")]


class Handle:
    """A map state in memory that counts its calls, and the timers."""

    def __init__(self):
        self.cells, self.timers, self.calls = {}, [], 0

    def getMapState(self, *_):
        return self

    def registerTimer(self, at):
        self.timers.append(at)

    def exists(self):
        return bool(self.cells)

    def containsKey(self, cell):
        self.calls += 1
        return cell in self.cells

    def getValue(self, cell):
        self.calls += 1
        return self.cells[cell]

    def updateValue(self, cell, value):
        self.calls += 1
        self.cells[cell] = value


@pytest.mark.parametrize("limit", [entities.HELD, 50])
def test_calls_to_the_state_follow_from_cells_and_not_from_keys(monkeypatch, limit):
    monkeypatch.setattr(entities, "HELD", limit)
    handle, once, cells = Handle(), entities.Once(), 8
    once.init(handle)

    class Clock:
        def getCurrentWatermarkInMs(self):
            return 0

    def batch(low, high):
        rows = [{"entity": "a", "day": 1, "key": str(i), "at_us": 1, "at_ms": -1 if i % 10 == 0 else 1, "value": "", "cell": i % cells} for i in range(low, high)]
        return pd.DataFrame(rows + rows)

    for given, want in (([(0, 400), (300, 500)], 450), ([(0, 500)], 0), ([(499, 502)], 1)):
        before = handle.calls
        out = pd.concat([*once.handleInputRows(("a", 1, 2, 0), iter([batch(*g) for g in given]), Clock())])
        assert (out.kind == "loaded").sum() == want and (out.kind == "late").sum() == 2 * sum(i % 10 == 0 for g in given for i in range(*g))
        assert handle.calls - before <= 3 * cells * len(given)
    assert sorted(int(k) for (keys,) in handle.cells.values() for k in keys) == [i for i in range(502) if i % 10]
    assert set(handle.timers) == {2 * entities.DAY}


def test_each_line_is_read_and_handed_to_a_state_once(spark, tmp_path, load):
    land(tmp_path, "orders", 1, [order(i, i % 20) for i in range(300)] + ["no json", {"id": 7}, {"updated_at": "2024-01-01"}])
    land(tmp_path, "other", 1, [order(1, 0)])
    query = load()
    progress = [json.loads(p.json) for p in query.recentProgress]
    assert sum(p["numInputRows"] for p in progress) == 304
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.asDict()["count"] for r in rows.groupBy("kind").count().collect()) == [4, 300]
    bad = {(r.value, str(r.at)) for r in entities.read_loaded(spark, str(tmp_path / "out"), "bad").collect()}
    assert bad == {("no json", "None"), ('{"id": 7}', "None"), ('{"updated_at": "2024-01-01"}', "2024-01-01 00:00:00"), (json.dumps(order(1, 0)), "None")}


def test_rows_are_packed_by_group_and_come_out_as_they_were(monkeypatch):
    monkeypatch.setattr(entities, "PIECE", 5_000)
    rows = [
        {"entity": [None, "a", "b"][i % 3], "key": None if i % 7 == 0 else f"k{i}", "value": f"v\n{i}", "at_us": None if i % 11 == 0 else i, "day": i % 2, "until": 5, "bucket": i % 4 // 2, "cell": i}
        for i in range(1000)
    ]
    kinds = [("entity", pa.string()), ("key", pa.string()), ("value", pa.string()), ("at_us", pa.int64()), ("day", pa.int32()), ("until", pa.int32()), ("bucket", pa.int32()), ("cell", pa.int32())]
    table = pa.Table.from_pylist(rows, pa.schema(kinds))
    packed = pa.Table.from_batches(entities.pack(iter(table.to_batches(max_chunksize=64))))
    assert 12 <= len(packed) < 200
    groups = {}
    for p in packed.to_pylist():
        inner = pa.ipc.read_record_batch(pa.py_buffer(p["rows"]), entities.INNER).to_pylist()
        groups.setdefault((p["entity"], p["day"], p["bucket"]), []).extend(r["cell"] for r in inner)
    assert len(groups) == 12 and all(g == sorted(g) for g in groups.values()) and sorted(sum(groups.values(), [])) == [*range(1000)]
    named = packed.append_column("kind", pa.array(["x"] * len(packed), pa.string()))
    out = pa.Table.from_batches(entities.unpack(iter(named.to_batches()))).to_pylist()
    want = [{"entity": r["entity"], "day": r["day"], "kind": "x", **{c: r[c] for c in ("key", "value", "at_us")}} for r in rows]
    assert sorted(map(repr, out)) == sorted(map(repr, want))


def test_a_state_gets_packed_rows_and_treats_them_as_rows():
    handle, once = Handle(), entities.Packed()
    once.init(handle)

    class Clock:
        def getCurrentWatermarkInMs(self):
            return 5

    def call(keys, ats, until=2):
        inner = pa.record_batch([pa.array(keys, pa.string()), pa.array([f"v{k}" for k in keys], pa.string()), pa.array([a * 1000 for a in ats], pa.int64()), pa.array([0] * len(keys), pa.int32())], schema=entities.INNER)
        frame = pd.DataFrame({"entity": ["a"], "day": [1], "until": [until], "bucket": [0], "rows": [inner.serialize().to_pybytes()]})
        out = pd.concat([*once.handleInputRows(("a", 1, until, 0), iter([frame]), Clock())])
        return {kind: pa.ipc.read_record_batch(pa.py_buffer(r), entities.INNER)["value"].to_pylist() for kind, r in zip(out.kind, out["rows"], strict=True)}

    assert call(["1", "1", "2", "3"], [5, 6, 4, 9]) == {"loaded": ["v1", "v3"], "late": ["v2"]}
    assert call(["3", "4"], [9, 9]) == {"loaded": ["v4"]}
    assert call([None, "5"], [9, 9], entities.NEVER) == {"bad": ["vNone", "v5"]}
    assert handle.timers == [2 * entities.DAY] * 2


ODD = [
    '{"id": 1, "updated_at": "2024-01-01"}', '{"id": 1, "id": 2, "updated_at": "2024-01-01", "updated_at": "2024-01-02"}', '{"\\u0069d": 3, "id": 4, "updated_at": "2024-01-01"}',
    "{'id': 5, \"id\": 6, 'updated_at': \"2024-01-01\"}", '{"id": "a\\"b\\n", "updated_at": "x"}', '{"id": 1.10, "updated_at": null}', '{"id": {"id": 7}, "updated_at": "2024-01-03"}',
    '{"id": [1, 2], "updated_at": "2024-01-01"} rest', '{"id": 8, "updated_at": "2024-01-01"', '[{"id": 9}]', '{"ID": 1}', '{"id": "", "updated_at": ""}', '{"id": true, "updated_at": 5}', "",
]


def test_fields_are_what_get_json_object_finds(spark, tmp_path):
    land(tmp_path, "orders", 1, ODD)
    land(tmp_path, "deep", 1, ['{"x": {"id": 1, "at": "2024-01-01"}, "id": 2}', '{"x.id": 3}'])
    kinds = [Entity("orders", ["id"], "updated_at"), Entity("deep", ["x.id", "id"], "x.at")]
    query = entities.read_landing(spark, str(tmp_path / "in"), kinds).writeStream.format("memory").queryName("fields").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    got = spark.table("fields")
    field = lambda name: F.get_json_object("value", f"$.{name}")
    one, two = (F.when(F.concat(*f).isNotNull(), F.to_json(F.array(*f))) for f in ([field("id")], [field("x.id"), field("id")]))
    want = got.select(
        "entity", F.when(F.col("entity") == "orders", one).otherwise(two).alias("key"),
        F.try_to_timestamp(F.when(F.col("entity") == "orders", field("updated_at")).otherwise(field("x.at"))).alias("at"), "value",
    )
    assert got.count() == len(ODD) + 2 and got.filter("key is not null").count() >= 10
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
