"""Readers for landed API responses and JSON flattening."""

from statlake.sources.flatten import flatten_json, flatten_wide
from statlake.sources.responses import (
    catalog_records,
    class_rows,
    meta_class_rows,
    meta_table_info,
    note_rows,
    page_info,
    parse_envelope,
    read_bodies,
    value_rows,
    wrap_records,
    wrap_texts,
)

__all__ = [
    "catalog_records", "class_rows", "flatten_json", "flatten_wide", "meta_class_rows",
    "meta_table_info", "note_rows", "page_info", "parse_envelope", "read_bodies",
    "value_rows", "wrap_records", "wrap_texts",
]
