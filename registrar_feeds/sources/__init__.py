"""Sources: fixed schemas, environment-aware readers, staging, test-data derivation."""

from registrar_feeds.sources.catalog import catalog_tables, register_tables, store_tables, table_name
from registrar_feeds.sources.fixtures import derive_tables, duckdb_ctes
from registrar_feeds.sources.registrar import (
    ENVIRONMENTS, check_env, read_tables, stage, stage_table, table_path, write_tables,
)
from registrar_feeds.sources.schemas import KEY_COLUMNS, SCHEMAS, TABLES, staged_schema


def fixture_tables(spark, sf_dir: str, sections_dir: str | None = None) -> dict:
    """Staged registrar tables derived (lazily) from the test data in ``sf_dir``;
    ``sections_dir`` as in ``derive_tables``."""
    return stage(derive_tables(spark, sf_dir, sections_dir))


__all__ = [
    "ENVIRONMENTS", "KEY_COLUMNS", "SCHEMAS", "TABLES", "catalog_tables", "check_env", "derive_tables",
    "duckdb_ctes", "fixture_tables", "read_tables", "register_tables", "stage", "stage_table", "store_tables",
    "table_name", "table_path", "staged_schema", "write_tables",
]
