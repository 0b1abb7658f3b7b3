"""Incremental builds over a stream of arriving feed files.

The source format is batch only; nothing stateful is added here.  The
row-level stage (split, null tokens, unescape, routing, index naming, ids,
documents and quarantine) is made of stateless expressions, so it runs
unchanged on a streaming DataFrame.  What needs the whole input (the shard
grid, mappings, manifests, whole-index replacement) stays in the batch build.
"""

from .feed import stream_rows, write_stream

__all__ = ["stream_rows", "write_stream"]
