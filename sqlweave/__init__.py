"""sqlweave: SQL lineage and ETL reporting jobs written as plain Spark DataFrame jobs.

Layers
------
* ``sources``    - readers for script files, query logs and the test tables; key-derived
                   sample corpora built by Spark from the given tables.
* ``functions``  - Column-level helpers (text cleaning, literal masking, statement kinds).
* ``operators``  - DataFrame -> DataFrame operators: statement split/filter, tokens and
                   scopes, table references, lineage records, column graph, JSON export.
* ``plans``      - the registered queries (lineage queries and the sample reporting jobs).
* ``streaming``  - the query-log stream (Structured Streaming, foreachBatch).
"""

__version__ = "0.1.0"
