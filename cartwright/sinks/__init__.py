"""Writers. Everything here runs a job and writes from the executors."""
from .files import write_ordered, write_processed_csv, write_raw_json
from .keyvalue import Resend, store_items, write_kv
from .tables import publish_table, upsert_table, write_documents

__all__ = [
    "Resend",
    "publish_table",
    "store_items",
    "upsert_table",
    "write_documents",
    "write_kv",
    "write_ordered",
    "write_processed_csv",
    "write_raw_json",
]
