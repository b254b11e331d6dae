"""A run becomes visible as a whole, and a stopped run goes on where it was."""

from uuid import uuid4

import pytest

from layerwright.plans import refresh as plan
from layerwright.plans import transactions as t
from layerwright.plans.manifest import Manifest, fingerprint
from layerwright.plans.refresh import Layout, Refresh
from layerwright.sources import tables, versions
from test_tables import HEADER, LINES

TABLES = [
    ("bronze", t.SPEC.table), ("silver", t.SPEC.table), ("quarantine", t.SPEC.table),
    *(("gold", name) for name in (*t.SUMMARIES, "high_risk_transactions", "top_sale_receivers")),
    *(("quality", name) for name in ("silver_report", "bronze_quality_report", "bronze_quality_distributions")),
]


OTHER_LINES = [
    "1609459200,s8,r8,44,sale,Europe,10.1,3,40,random,new,60,moderate_risk",
    "1609459200,s9,r9,77,sale,Europe,10.1,3,40,random,veteran,90,high_risk",
]


@pytest.fixture
def files(tmp_path):
    """Two inputs: every table differs between them."""
    made = []
    for name, lines in (("old", LINES), ("new", [*LINES[1:3], *OTHER_LINES, LINES[5]])):
        (tmp_path / name).mkdir()
        path = tmp_path / name / t.SPEC.key
        path.write_text("\n".join([HEADER, *lines]) + "\n")
        made.append(str(path))
    return made


class Stopped(Exception):
    pass


def state(refresh):
    """What each table shows, without the times of the run."""
    shown = {}
    for name in TABLES:
        df = refresh.table(*name)
        kept = [c for c in df.columns if c not in ("report_timestamp", "_created_at", "_batch_id") and not c.endswith("_time")]
        shown[name] = sorted(map(str, df.select(*kept).collect()))
    return shown


def stopping_after(monkeypatch, module, name, calls):
    """Let the function raise when it is called once more than ``calls`` times."""
    real, left = getattr(module, name), [calls]

    def function(*args, **how):
        if left[0] == 0:
            raise Stopped
        left[0] -= 1
        return real(*args, **how)

    monkeypatch.setattr(module, name, function)


# (where the run stops, how many calls it may make there). Each run goes on where the one before it was stopped: in a
# layer, when a layer is recorded, at the switch, between the names before and after the switch is on.
STOPS = [("stage_table", 0), ("stage_table", 1), ("stage_table", 5), ("stage_table", 8), ("define", 0), ("define", 1),
         ("define", 7), ("define", 14), ("define", 15), ("define", 20)]


def test_a_stopped_run_shows_all_old_or_all_new_tables(spark, files, monkeypatch):
    old_path, new_path = files
    layout = Layout(prefix=f"r{uuid4().hex[:10]}_")
    refresh = Refresh(spark, layout)
    refresh.run(old_path)
    old = state(refresh)
    seen = []
    for where, calls in STOPS:
        module = plan if where == "stage_table" else versions
        with monkeypatch.context() as patch:
            stopping_after(patch, module, where, calls)
            with pytest.raises(Stopped):
                refresh.run(new_path)
        shown = state(refresh)
        if shown != old:
            seen.append(shown)
            assert not any(shown[name] == old[name] for name in TABLES)
    assert seen and all(shown == seen[0] for shown in seen)
    refresh.run(new_path)
    assert state(refresh) == seen[0] and refresh.manifest().read() == {}


def test_a_stopped_run_goes_on_after_its_last_finished_layer(spark, files, monkeypatch):
    refresh = Refresh(spark, Layout(prefix=f"r{uuid4().hex[:10]}_"))
    with monkeypatch.context() as patch:
        stopping_after(patch, plan, "stage_table", 5)  # bronze, silver and quarantine are done
        with pytest.raises(Stopped):
            refresh.run(files[0])
    (steps,) = refresh.manifest().read().values()
    assert list(steps) == ["raw", "clean"] and [v.rows for v in steps["clean"]] == [3, 4]
    written = []
    with monkeypatch.context() as patch:
        patch.setattr(plan, "stage_table", lambda df, name, **how: written.append(name) or tables.stage_table(df, name, **how))
        counts = refresh.run(files[0])
    assert len(written) == 10 and not [name for name in written if "bronze." in name or "silver." in name]
    assert counts["bronze.tb_fraud_credit"] == 7 and len(counts) == 13
    assert all(refresh.table(*name.split(".")).count() == n for name, n in counts.items())


def test_other_input_starts_anew(spark, files, monkeypatch):
    refresh = Refresh(spark, Layout(prefix=f"r{uuid4().hex[:10]}_"))
    with monkeypatch.context() as patch:
        stopping_after(patch, plan, "stage_table", 1)
        with pytest.raises(Stopped):
            refresh.run(files[0])
    ((left,),) = [steps["raw"] for steps in refresh.manifest().read().values()]
    assert refresh.run(files[1])["bronze.tb_fraud_credit"] == 5
    assert not spark.catalog.tableExists(left.table)


def test_fingerprint_follows_files_and_settings(spark, files, tmp_path):
    first = fingerprint(spark, files[0], "a")
    assert first == fingerprint(spark, files[0], "a") != fingerprint(spark, files[0], "b") != fingerprint(spark, files[1], "b")
    with open(files[0], "a") as file:
        file.write(LINES[0] + "\n")
    assert fingerprint(spark, files[0], "a") != first


def test_manifest_quotes_what_it_records(spark):
    manifest = Manifest(spark, f"m{uuid4().hex[:10]}.run_x")
    version = versions.Version("a.b", "a__versions.b__1", "/it's/a \\ path", 12)
    manifest.record("mark", {"raw": [version], "clean": [version, version]})
    assert manifest.read() == {"mark": {"raw": [version], "clean": [version, version]}}
    manifest.clear()
    assert manifest.read() == {}


def test_steps_publish_their_tables_together(spark, files, monkeypatch):
    refresh = Refresh(spark, Layout(prefix=f"r{uuid4().hex[:10]}_"))
    refresh.run(files[0])
    refresh.write_raw(files[1])
    with monkeypatch.context() as patch:
        stopping_after(patch, versions, "define", 2)  # the switch and one of two names
        with pytest.raises(Stopped):
            refresh.write_clean()
    assert (refresh.table("silver").count(), refresh.table("quarantine").count()) == (3, 4)
    refresh.write_clean()
    assert (refresh.table("silver").count(), refresh.table("quarantine").count()) == (4, 1)
