"""runvault: the data side of ML pipelines as Spark DataFrame operators.

Subpackages
-----------
sources    file listings, byte-range reads, archive / marker / ledger scans
operators  DataFrame -> DataFrame operators (chunks, entities, ledger, diff,
           params, cells, artifacts)
functions  column-expression helpers (run ids, paths, names, globs)
sinks      archive writer, file restorer, versioned publish, ledger append
plans      views over the driver tables, the registered queries and their
           DuckDB oracles
streaming  (intentionally empty: the library has no stream semantics)
"""

__version__ = "0.1.0"
