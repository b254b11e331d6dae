"""Layered batch tables on Spark: ingest, validate, enrich, summarise, report and test, all as DataFrames."""

from layerwright.spec import TableSpec, load_spec

__all__ = ["TableSpec", "load_spec"]
