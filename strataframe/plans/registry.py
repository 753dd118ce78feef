"""All queries of the library by name, with the SQL that gives the same rows in DuckDB where SQL can express it."""

from strataframe.plans import archive_queries, catalog_queries, frame_queries, gate_queries

QUERIES: dict = {**frame_queries.QUERIES, **catalog_queries.QUERIES, **archive_queries.QUERIES, **gate_queries.QUERIES}
ORACLE: dict = {**frame_queries.ORACLE, **catalog_queries.ORACLE, **archive_queries.ORACLE, **gate_queries.ORACLE}
FLAGSHIP = "frame_index"
