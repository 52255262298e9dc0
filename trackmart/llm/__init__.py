"""Training-data operators: packing, deduplication, decontamination, language
and quality scoring, extraction, rollups, sharding and fingerprints. Nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it."""
