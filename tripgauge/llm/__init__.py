"""Operators for large training-data pipelines (secret scans, quality rules, dedup, packing, ...).

Nothing else in the library imports this subpackage; its queries are in
``queries.py`` and the end-to-end pipeline in ``corpus_pipeline.py`` at the
repository top.
"""
