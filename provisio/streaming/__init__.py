"""Structured Streaming forms of the market and staging operators (X-1 … X-3).

Each stream runs with an ``availableNow`` trigger over the files present,
keeps its checkpoint in the shared checkpoint folder, and writes micro-batch
results idempotently (one folder per batch id, overwritten on retry), so a
lost executor or a restarted query never duplicates output.
"""
