"""Spark-first preparation of crawled encyclopedia pages for language-model training."""
