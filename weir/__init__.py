"""weir: a Spark engine for building and querying provenance-tracked corpora."""
