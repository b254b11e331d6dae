"""Command line: run one step of a refresh, or all of them.

    python -m layerwright all /data/df_fraud_credit.csv --document /reports/quality
    spark-submit --py-files layerwright.zip submit.py all /data/df_fraud_credit.csv

The session, its catalog, its time zone and ``spark.checkpoint.dir`` come from the submit configuration.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from layerwright.plans.refresh import Layout, Refresh
from layerwright.plans.transactions import SPEC
from layerwright.spec import load_spec

STEPS = ("raw", "clean", "summaries", "reports", "tests", "all")


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="layerwright", description="Refresh the layers of a transaction table.")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("path", nargs="?", help="raw CSV file or folder (steps raw and all)")
    parser.add_argument("--spec", help="YAML or JSON file with table specs; default is the built-in spec")
    parser.add_argument("--key", default=SPEC.key, help="source file key in the spec file")
    parser.add_argument("--catalog", help="configured catalog for the tables")
    parser.add_argument("--document", help="folder for the JSON quality report")
    given = parser.parse_args(arguments)
    if given.step in ("raw", "all") and not given.path:
        parser.error(f"step {given.step} needs a path")

    spec = load_spec(given.spec, given.key) if given.spec else SPEC
    spark = SparkSession.builder.appName(f"layerwright {given.step}").getOrCreate()
    refresh = Refresh(spark, Layout(catalog=given.catalog), spec)
    if given.step == "tests":
        refresh.write_tests()
        failed = 0
        for table in ("table_tests", "invariants"):  # a row per declared test
            for row in refresh.table("quality", table).collect():
                print(*row)
                failed += row.status == "FAIL"
        return int(failed > 0)
    written = {
        "raw": lambda: refresh.write_raw(given.path),
        "clean": refresh.write_clean,
        "summaries": refresh.write_summaries,
        "reports": lambda: refresh.write_reports(given.document),
        "all": lambda: refresh.run(given.path, given.document),
    }[given.step]()
    for table, rows in written.items():
        print(f"{table}: {rows} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
