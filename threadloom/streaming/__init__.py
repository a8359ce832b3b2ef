"""Incremental runs: the batch functions applied to pages as they arrive."""
