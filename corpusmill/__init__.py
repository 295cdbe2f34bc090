"""Corpus and catalog analytics on PySpark: DataFrame in, DataFrame out."""
