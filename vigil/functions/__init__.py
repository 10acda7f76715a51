"""Column functions: keys, parsing, partition buckets, JSON and text forms,
and the value encoders of the scoring model. All are plain Spark Columns,
so they stay inside whole-stage codegen."""
