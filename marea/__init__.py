"""marea: model-lifecycle and document-retrieval jobs as Spark DataFrames."""
