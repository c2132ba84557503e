"""voxloom: a Spark-first engine for curating speech and text corpora."""
