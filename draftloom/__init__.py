"""draftloom: a Spark-first engine for corpora of paired text (draft and rewrite)."""
