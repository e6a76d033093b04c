"""quarry: parameterised PySpark DataFrame jobs for table, text, graph and
recommendation work.

Sub-packages
------------
sources    readers for delimited files, text lines, name dimensions, tables
functions  column-expression helpers (no Python UDFs)
operators  the jobs: relational summaries, lookups, word count, graph
           degree / BFS, item similarity, ALS recommendations, splits
plans      the named queries over the driver tables and their SQL oracles
streaming  the same operators run over a streaming file source
"""

from quarry.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
