"""winnow: curation of training data as Spark plans."""
