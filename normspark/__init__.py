"""Document-graph analytics on Spark: relational, tree and graph operators for regulatory texts."""
