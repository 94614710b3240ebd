"""Training-data operators (HTML text, decontamination, token counts, BPE, PII,
near-duplicates, licences, substring dedup, fingerprints, toxicity).

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
registers ``registry.QUERIES`` when it is present.
"""
