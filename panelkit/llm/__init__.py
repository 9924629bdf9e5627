"""Training-data operators: one module per operator, a registry in ``queries``.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
