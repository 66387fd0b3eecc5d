"""Sources: raw parquet tables, derived domain tables, catalogs, reference data."""

from .fixtures import Fixtures, RECIPES, RAW_TABLES, duckdb_with  # noqa: F401
