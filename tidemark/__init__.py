"""tidemark: posting analytics as Spark DataFrame operators.

Raw postings from several sources become one normalized table, then a deduplicated
table with monthly pay, then a long (posting, term) table, then four small marts
and the queries over them.
"""

__version__ = "0.1.0"
