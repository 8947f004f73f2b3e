"""End-to-end plans composed from the operators."""

from .enrich import enrich_and_label, enrich_catalog, enrich_folder, upsert_catalog
from .harvest import PRESETS, harvest, harvest_to, land, select_landed, select_records
from .merge import merge_shards
from .sheet import merge_catalog_with_sheet

__all__ = ["PRESETS", "enrich_and_label", "enrich_catalog", "enrich_folder", "harvest", "harvest_to",
           "land", "merge_catalog_with_sheet", "merge_shards", "select_landed", "select_records", "upsert_catalog"]
