"""Training-data operators: ten operators for corpora of documents, vectors and pages.

Nothing outside this subpackage (and ``corpus_pipeline.py``, which belongs to it) imports it.
"""
