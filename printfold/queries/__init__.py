"""Every operator run over the driver tables.

Each entry calls the library's operators on whole tables and comes with SQL that states the same
result another way. ``QUERIES`` and ``SQL`` are keyed by query name.
"""

from printfold.queries import catalogue, columns, folds, loads, pictures, sources, streams
from printfold.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "catalogue", "columns", "folds", "loads", "pictures", "sources", "streams"]
