"""Readers: landed records, file listings, catalogue and sheet tables."""

from .files import (batch_files, file_name, latest_dataset, list_files, run_date_range,
                    shard_files)
from .items import items_from_text, page_meta, quarantine, read_items, read_pages, read_rejects
from .tables import read_catalog, read_client_ids, read_sheet

__all__ = [
    "batch_files", "file_name", "items_from_text", "latest_dataset", "list_files",
    "page_meta", "quarantine", "read_catalog", "read_client_ids", "read_items",
    "read_pages", "read_rejects", "read_sheet", "run_date_range", "shard_files",
]
