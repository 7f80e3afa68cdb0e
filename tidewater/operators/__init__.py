"""Keyed tables: upsert, delete, incremental and as-of reads, maintenance."""
