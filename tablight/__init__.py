"""tablight: tabular cleaning, profiling, classification and clustering on Spark.

Every operator takes and returns Spark DataFrames (or a small driver-side
summary of a distributed aggregate). The heavy lifting is declared with the
DataFrame / SQL API so Catalyst can prune, push down and plan it; Python runs
inside tasks only where no built-in expression can express the semantics
(nearest-neighbour blocks, kernel features, image decoding).

Subpackages
-----------
sources    scans and sinks (CSV with null tokens, parquet tables, images, models)
functions  column-expression helpers and distributed building blocks
           (exact quantiles, global ranks / running sums)
operators  the operator inventory (cleaning, profiling, association, features,
           splits, evaluation, classifiers, clustering, leaderboards)
plans      composed workflows and the driver-table query catalogue
streaming  the cleaning + scoring path as a Structured Streaming query
"""

__version__ = "0.1.0"
