"""Streaming: incremental, exactly-once ingest of month files (see ``ingest``).

The queries themselves are batch; the original application has no streaming
operator, so none is added here.
"""
