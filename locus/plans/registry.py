"""The genome-table queries and their SQL."""

from . import copy_queries, element_queries, mutation_queries, pipeline_queries, source_queries, sv_queries, track_queries

MODULES = (track_queries, mutation_queries, sv_queries, copy_queries, element_queries, source_queries, pipeline_queries)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
