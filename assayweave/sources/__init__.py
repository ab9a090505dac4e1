from .mapping import read_bulk_mapping
from .raw import (
    enforce_schema,
    flatten_nested,
    read_raw,
    row_hash,
    schema_violations,
    stringify_nested,
    with_provenance,
    write_entity,
)
from .schemas import RAW_SCHEMAS, RULES, Rule

__all__ = [
    "RAW_SCHEMAS",
    "RULES",
    "Rule",
    "enforce_schema",
    "flatten_nested",
    "read_bulk_mapping",
    "read_raw",
    "row_hash",
    "schema_violations",
    "stringify_nested",
    "with_provenance",
    "write_entity",
]
