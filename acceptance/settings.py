"""Values that the queries and their oracles share."""

KEY = "key-of-the-acceptance-queries"
SEED = 7
ATTRIBUTES = {"column": "c_mktsegment"}
