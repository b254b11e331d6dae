"""Names over versions: no gap, no mixture, pinned readers, collected leftovers."""

import threading
from datetime import timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from layerwright.sources import tables, versions


@pytest.fixture
def space(spark):
    name = f"v{uuid4().hex[:10]}"
    tables.ensure_namespace(spark, name)
    return name


def frame(spark, value, rows=40):
    return spark.range(rows).select(F.lit(value).alias("value"), "id")


def values(spark, name):
    return {r.value for r in tables.read_table(spark, name).select("value").distinct().collect()}


def test_a_reader_loops_through_twenty_replacements(spark, space):
    name = f"{space}.tb"
    tables.replace_table(frame(spark, 0), name)
    stop, seen, faults = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                assert spark.catalog.tableExists(name)
                found = tables.read_table(spark, name).agg(F.count("*").alias("n"), F.min("value").alias("a"), F.max("value").alias("b")).first()
                seen.append((found.n, found.a, found.b))
            except Exception as fault:  # noqa: BLE001
                faults.append(fault)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 21):
        tables.replace_table(frame(spark, i), name)
    stop.set()
    reader.join()
    assert not faults and len(seen) > 5
    assert all(n == 40 and a == b for n, a, b in seen) and [a for _, a, _ in seen] == sorted(a for _, a, _ in seen)


def test_a_reader_keeps_its_version(spark, space):
    name = f"{space}.tb"
    tables.replace_table(frame(spark, "old"), name)
    pinned = tables.read_table(spark, name)
    tables.replace_table(frame(spark, "new", 7).withColumn("more", F.lit(1)), name)
    assert pinned.count() == 40 and pinned.columns == ["value", "id"]
    fresh = tables.read_table(spark, name)
    assert fresh.count() == 7 and fresh.columns == ["value", "id", "more"]


def test_collection_by_age(spark, space):
    name = f"{space}.tb"
    for i in range(4):
        tables.replace_table(frame(spark, i), name, retain=timedelta(hours=1))
    assert len(versions.folders(spark, name)) == 4
    assert versions.collect(spark, name, timedelta(hours=1)) == []
    unfinished = versions.fresh(spark, name)  # newer than what the name shows: a write under way
    frame(spark, 9).write.format("parquet").option("path", unfinished.path).saveAsTable(unfinished.table)
    assert len(versions.collect(spark, name, timedelta(0))) == 3
    assert len(versions.folders(spark, name)) == 2 and values(spark, name) == {3}
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {space}__versions").collect()]
    assert len(left) == 2
    versions.publish(spark, [unfinished], retain=timedelta(0))
    assert values(spark, name) == {9} and len(versions.folders(spark, name)) == 1


def test_a_name_without_versions_has_nothing_to_collect(spark, space):
    assert versions.collect(spark, f"{space}.nothing", timedelta(0)) == [] and versions.live(spark, f"{space}.nothing") is None


def test_a_plain_table_gives_way(spark, space):
    spark.range(3).write.saveAsTable(f"{space}.tb")
    assert tables.replace_table(frame(spark, 1), f"{space}.tb") == 40
    assert values(spark, f"{space}.tb") == {1}


class Stopped(Exception):
    pass


@pytest.mark.parametrize("known_before", [True, False])
def test_several_names_change_at_one_moment(spark, space, monkeypatch, known_before):
    """Stop the publication before each of its metadata calls: all names show the old rows, or all the new ones."""
    names = [f"{space}.a", f"{space}.b", f"{space}.c"]
    if known_before:
        for name in names:
            tables.replace_table(frame(spark, "old"), name)
    define, states = versions.define, []
    for stop_at in range(20):
        staged = [tables.stage_table(frame(spark, "new"), name) for name in names]
        calls = iter(range(1000))

        def stopping(*args, calls=calls, stop_at=stop_at):
            if next(calls) == stop_at:
                raise Stopped
            define(*args)

        monkeypatch.setattr(versions, "define", stopping)
        try:
            tables.publish(spark, staged)
            finished = True
        except Stopped:
            finished = False
        monkeypatch.setattr(versions, "define", define)
        shown = {frozenset(values(spark, n)) if spark.catalog.tableExists(n) else frozenset() for n in names}
        assert len(shown) == 1, (stop_at, shown)
        states.append(shown.pop())
        if finished:
            break
        for name, version in zip(names, staged, strict=True):
            if states[-1] == {"new"}:
                assert versions.live(spark, name) == version.table
        if states[-1] == {"new"} and known_before:  # back to the start for the next stop
            tables.publish(spark, [tables.stage_table(frame(spark, "old"), name) for name in names])
    old = frozenset({"old"}) if known_before else frozenset()
    first_new = states.index(frozenset({"new"}))
    assert states[0] == old and set(states[:first_new]) == {old} and set(states[first_new:]) == {frozenset({"new"})}
    assert all(versions.SWITCH not in versions._properties(spark, name) for name in names)


def test_only_the_shown_side_is_read_while_names_are_switched(spark, space, monkeypatch):
    names = [f"{space}.a", f"{space}.b"]
    for name in names:
        tables.replace_table(frame(spark, "old"), name)
    staged = [tables.stage_table(frame(spark, "new").withColumn("more", F.lit(2)), name) for name in names]
    monkeypatch.setattr(versions, "_show", lambda *a: (_ for _ in ()).throw(Stopped()))
    with pytest.raises(Stopped):
        tables.publish(spark, staged)
    df = tables.read_table(spark, names[0])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and staged[0].table in plan and df.columns == ["value", "id", "more"]
    assert versions.live(spark, names[0]) == staged[0].table


def test_columns_may_change_while_names_are_switched(spark, space, monkeypatch):
    names = [f"{space}.a", f"{space}.b"]
    for name in names:
        tables.replace_table(frame(spark, "old"), name)
    staged = [tables.stage_table(spark.range(5).select(F.lit(1.5).alias("value"), F.lit("z").alias("z")), name) for name in names]
    turn = versions._turn
    monkeypatch.setattr(versions, "_turn", lambda s, name, on: (_ for _ in ()).throw(Stopped()) if on else turn(s, name, on))
    with pytest.raises(Stopped):
        tables.publish(spark, staged)
    assert tables.read_table(spark, names[1]).count() == 40
    monkeypatch.setattr(versions, "_turn", turn)
    tables.publish(spark, staged)
    assert [r.value for r in tables.read_table(spark, names[1]).collect()] == [1.5] * 5
