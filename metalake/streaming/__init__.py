"""Structured Streaming jobs: resumable ingest (H1) and best row per key (H2)."""

from .ingest import (best_row_updates, compact_best_rows, ingest_records, maintain_best_rows, read_best_rows,
                     read_best_state, read_ingest_rejects, read_ingested, record_stream)

__all__ = ["best_row_updates", "compact_best_rows", "ingest_records", "maintain_best_rows", "read_best_rows",
           "read_best_state", "read_ingest_rejects", "read_ingested", "record_stream"]
