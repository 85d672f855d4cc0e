"""Training-data operators: mixing, deduplication, filters, archives.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
