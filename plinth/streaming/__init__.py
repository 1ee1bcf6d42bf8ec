"""Structured Streaming forms of the incremental operators.

The reference has no streams; its run log and submission log are append-only
files updated one entry at a time.  The same appends are expressed here as
file-source streams with ``foreachBatch`` sinks (idempotent per batch id), so a
log can be fed continuously instead of by reruns.
"""
