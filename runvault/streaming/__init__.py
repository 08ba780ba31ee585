"""Streaming.

The library keeps versioned datasets, run records and archives; none of its
operations has stream semantics (no watermark, event-time window or
incremental state).  Every operator is a batch DataFrame function, and the
ones that read growing tables (ledger, metric log) are idempotent, so they can
run inside ``foreachBatch`` of a user's stream unchanged.  Nothing else lives
here on purpose.
"""
