"""Spark jobs for a news crawl: discovery, fetch frontier, extraction, embedding, reports.

Every operator takes DataFrames (or Columns) and gives one back. Nothing here
opens a network connection or reads the clock: fetched bodies, model results
and the reference time ``as_of`` are inputs.
"""

from presslake.session import checkpoint_root, configure, materialize, scratch_path

__all__ = ["checkpoint_root", "configure", "materialize", "scratch_path"]
