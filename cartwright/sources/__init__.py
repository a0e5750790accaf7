"""Readers: landed JSON documents, stored tables, ranges, status files."""
from .documents import Landed, load_seed, read_carts, read_landed, read_users, unwrap_envelope
from .rows import order_ids, users_from_rows
from .tables import (
    load_write_status,
    read_jdbc,
    read_ordered,
    read_processed_csv,
    read_table,
    register_views,
)

__all__ = [
    "Landed",
    "load_seed",
    "load_write_status",
    "order_ids",
    "read_carts",
    "read_jdbc",
    "read_landed",
    "read_ordered",
    "read_processed_csv",
    "read_table",
    "read_users",
    "register_views",
    "unwrap_envelope",
    "users_from_rows",
]
