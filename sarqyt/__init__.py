"""Corpus curation on Spark: composable ``DataFrame -> DataFrame`` operators."""
