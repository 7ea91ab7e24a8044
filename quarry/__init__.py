"""quarry: web-page search analytics as Spark DataFrame jobs.

Pages are parsed into records, links become an edge table, PageRank is an
iterative join, the inverted index is a set of ordinary tables and every
search operator answers a whole table of queries at once.
"""

from quarry.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
