"""Transaction rows made from the order tables, one per line item, and the same rows in DuckDB SQL.

lineitem joins orders, customer with nation and region for the sender, supplier for the receiver, and part for the
session. Some (line number, discount) pairs carry a planted fault
each, so that every requirement and every reject rule has rows. The value lists are those of the shipped spec.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators.columns import apply_column_ops
from layerwright.operators.enrich import enrich
from layerwright.operators.validate import split
from layerwright.plans import refresh
from layerwright.plans.transactions import SPEC
from layerwright.sources.scratch import write_once

TYPE_OF_PRIORITY = {
    "1-URGENT": "phishing", "2-HIGH": "sale", "3-MEDIUM": "purchase", "4-NOT SPECIFIED": "transfer", "5-LOW": "scam",
}
REGION_OF = {
    "AFRICA": "Africa", "AMERICA": "North America", "ASIA": "Asia", "EUROPE": "Europe", "MIDDLE EAST": "South America",
}
CLASS_OF_FLAG = {"A": "low_risk", "N": "moderate_risk", "R": "high_risk"}
PATTERN_OF_SEGMENT = {"AUTOMOBILE": "focused", "BUILDING": "high_value"}  # all others: random
AGE_OF_STATUS = {"F": "established", "O": "new", "P": "veteran"}

# column -> [(line number, discount, planted value as SQL)]
FAULTS = {
    "timestamp": [(7, 0.01, "NULL")],
    "sending_address": [(7, 0.10, "NULL")],
    "receiving_address": [(7, 0.00, "NULL")],
    "amount": [(6, 0.10, "NULL"), (6, 0.00, "-l_extendedprice"), (6, 0.01, "0"), (1, 0.10, "-1")],
    "location_region": [(5, 0.10, "NULL"), (5, 0.00, "'0'"), (1, 0.10, "'0'")],
    "risk_score": [(4, 0.10, "NULL"), (4, 0.00, "150"), (4, 0.01, "-5"), (1, 0.00, "CAST('NaN' AS DOUBLE)")],
    "anomaly": [(3, 0.10, "'unknown'"), (3, 0.00, "NULL")],
    "transaction_type": [(2, 0.10, "'refund'"), (2, 0.00, "NULL")],
}


def _case(column: str, words: dict[str, str], rest: str = "NULL") -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + f" ELSE {rest} END"


def _planted(column: str, sound: str) -> str:
    """The sound value with the faults of the column planted. Plain SQL, the same text for both engines."""
    faults = "".join(
        f"WHEN l_linenumber = {line} AND l_discount = {discount} THEN {value} "
        for line, discount, value in FAULTS.get(column, ())
    )
    return f"CASE {faults}ELSE {sound} END" if faults else sound


def _columns(seconds: str) -> dict[str, str]:
    sound = {
        "timestamp": f"CAST({seconds} AS INT)",
        "sending_address": "c_name",
        "receiving_address": "s_name",
        "amount": "l_extendedprice",
        "transaction_type": _case("o_orderpriority", TYPE_OF_PRIORITY),
        "location_region": _case("r_name", REGION_OF),
        "ip_prefix": "n_name",
        "login_frequency": "l_linenumber",
        "session_duration": "CAST(p_size AS INT)",
        "purchase_pattern": _case("c_mktsegment", PATTERN_OF_SEGMENT, "'random'"),
        "age_group": _case("o_orderstatus", AGE_OF_STATUS),
        "risk_score": "l_quantity * 2",
        "anomaly": _case("l_returnflag", CLASS_OF_FLAG),
    }
    planted = {name: _planted(name, expression) for name, expression in sound.items()}
    planted["amount"] = f"CAST({planted['amount']} AS DECIMAL(18,2))"
    return planted


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 13 source columns, ``timestamp`` as epoch seconds.

    Orders meet their senders first, so a sender with a third of all orders is skewed in the smaller join only. Line items meet
    parts and receivers before orders, while they are narrow: from the size on where those are too large to be broadcast, each
    of these joins shuffles the line items, and the texts of a sender would more than double what a row of them takes. No join is
    hinted: Spark broadcasts what its size statistics allow, and adaptive execution splits skewed partitions of the other joins."""
    senders = (
        read(spark, sf_dir, "customer")
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")
    )
    receivers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_size")
    orders = read(spark, sf_dir, "orders").join(senders, F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        read(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(receivers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    columns = _columns("unix_seconds(CAST(l_shipdate AS TIMESTAMP))")
    return joined.select(*(F.expr(e).cast(_kind(n)).alias(n) for n, e in columns.items()))


def _kind(name: str) -> str:
    kinds = {"timestamp": "int", "amount": "decimal(18,2)", "risk_score": "double"}
    return kinds.get(name, "int" if name in ("login_frequency", "session_duration") else "string")


_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


def _layer(spark: SparkSession, sf_dir: str, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """A layer is a table: it is written once per application, on first use, into the shared folder, and every
    query over it is a scan that prunes columns and pushes filters down. Feeding the source expressions straight
    into the row rules would also fuse both into methods too large for the JIT compiler."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.conf.get("spark.app.id"), sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = write_once(rows(), name)
    return _WRITTEN[key]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "bronze", lambda: apply_column_ops(source_rows(spark, sf_dir), SPEC))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(
        spark, sf_dir, "silver", lambda: enrich(split(bronze(spark, sf_dir), SPEC).valid, SPEC.derivations)
    )


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, "rejected", lambda: split(bronze(spark, sf_dir), SPEC).rejected)


def outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The written summaries and reports. Those that are not there yet are written side by side."""
    clean, raw = silver(spark, sf_dir), bronze(spark, sf_dir)
    frames = refresh.gold_frames(clean, _layer(spark, sf_dir, "rollup", lambda: refresh.shared_rollup(clean)))
    frames |= refresh.report_frames(raw, clean, "now")
    with ThreadPoolExecutor(max_workers=4) as pool:
        written = pool.map(lambda name: _layer(spark, sf_dir, name, lambda: frames[name]), frames)
        return dict(zip(frames, written, strict=True))


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and timestamps as text, so that both engines print them alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def duckdb_source() -> str:
    columns = _columns("epoch(l_shipdate)")
    selected = ",\n    ".join(f'{expression} AS "{name}"' for name, expression in columns.items())
    return f"""SELECT
    {selected}
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey"""
