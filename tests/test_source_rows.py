"""Source rows from order tables that are made here."""

import pytest

from workload import tx

TABLES = {
    "region": ("r_regionkey long, r_name string", [(1, "ASIA"), (2, "EUROPE")]),
    "nation": ("n_nationkey long, n_name string, n_regionkey long", [(5, "JAPAN", 1), (6, "FRANCE", 2)]),
    "customer": ("c_custkey long, c_name string, c_nationkey long, c_mktsegment string", [(1, "c1", 5, "BUILDING"), (2, "c2", 6, "X"), (2, "c2b", 5, "X")]),
    "supplier": ("s_suppkey long, s_name string", [(1, "s1"), (2, "s2")]),
    "part": ("p_partkey long, p_size int", [(1, 10), (2, 20), (2, 21)]),
    "orders": ("o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string", [(1, 1, "5-LOW", "F"), (2, 2, "2-HIGH", "O"), (None, 1, "5-LOW", "F")]),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_returnflag string, l_shipdate date",
        [(1, 1, 1, 1, 5.0, 9.0, 0.05, "A"), (1, 2, 2, 2, 6.0, 8.0, 0.05, "N"), (2, 1, 2, 1, 7.0, 7.0, 0.05, "R"), (None, 1, 1, 1, 1.0, 1.0, 0.05, "A"), (9, 1, 1, 1, 1.0, 1.0, 0.05, "A")],
    ),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    from datetime import date

    path = str(tmp_path_factory.mktemp("orders"))
    for name, (schema, rows) in TABLES.items():
        rows = [(*row, date(2020, 1, 2)) for row in rows] if name == "lineitem" else rows
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_each_line_item_with_its_order_part_and_receiver(spark, folder):
    rows = tx.source_rows(spark, folder).select("sending_address", "receiving_address", "amount", "session_duration", "location_region").collect()
    found = sorted((*r[:2], float(r[2]), *r[3:]) for r in rows)
    want = [("c1", "s1", 9.0, 10, "Asia"), ("c1", "s2", 8.0, 20, "Asia"), ("c1", "s2", 8.0, 21, "Asia"), ("c2", "s2", 7.0, 10, "Europe"), ("c2b", "s2", 7.0, 10, "Asia")]
    assert found == want


def test_line_items_meet_orders_last(spark, folder):
    """Where nothing is broadcast, the texts of the senders are not shuffled along with the line items."""
    plan = tx.source_rows(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 6 and "l_orderkey" in joins[0]
