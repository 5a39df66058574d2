"""Training-data operators: token files, sharding, archives, mixing, deduplication, cleaning, language, packing.

Nothing outside this subpackage imports it; ``corpus_pipeline.py`` at the repository top chains five of
its operators.
"""
