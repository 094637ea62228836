"""Operators for training-data pipelines, each on its own and chained in ``corpus_pipeline.py``."""
