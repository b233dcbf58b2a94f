"""stockflow: make-to-stock planning analytics on Spark DataFrames.

Packages:
    sources    raw inputs (test-data fixtures), catalog tables, JDBC, bronze ingest
    functions  column-level cleaning and derived-value expressions
    operators  silver cleaners and domains, demand, inventory, production, ranking
    plans      the layered pipeline, the named query registry and its SQL oracle
    streaming  none (batch only)
"""
