"""labelloom: multi-label tagging of text collections, written as Spark jobs."""
