"""Training-data operators: sharding, chat formatting, token files, packing, near-dedup, line dedup,
exact vector search, personal data, benchmark decontamination and toxicity scoring.

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
