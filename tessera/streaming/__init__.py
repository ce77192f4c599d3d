"""Incremental runs of the per-row operators.

The original work has no unbounded input, so there are no stateful streaming operators.
The per-row extraction jobs (page links, items, headers, phone numbers, chunking) are
stateless, so the same DataFrame functions run unchanged on a Structured Streaming
source; ``run_incremental`` processes whatever new files arrived and stops.
"""

from tessera.streaming.incremental import run_incremental

__all__ = ["run_incremental"]
