"""clickflow — e-commerce click-log and ad-click analytics on Spark DataFrames.

Every job is a ``DataFrame -> DataFrame`` function with plain arguments, so the same
code runs in batch and inside Structured Streaming ``foreachBatch`` bodies.

Layout:
  sources/    table scans, typed rows, ad-log line parsing, stream sources
  functions/  column-level helpers (lists, time labels, JSON)
  operators/  the jobs: category top-N, session top-N, page jump rate, ads, blacklist
  sinks/      JDBC, managed tables, replay-safe keyed tables
  streaming/  Structured Streaming versions of the ad jobs
  plans/      job runners that wire source -> operator -> sink, plan inspection
"""

from clickflow.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
