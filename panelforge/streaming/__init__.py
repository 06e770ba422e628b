"""Structured Streaming.

Intentionally empty: the reference study reads finite files only and has no
watermark, window, state or late-data logic, so there is nothing to port.
The batch operators work unchanged on ``foreachBatch`` micro-batches.
"""
