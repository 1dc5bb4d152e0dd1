"""Incremental ingestion of landed report files."""
