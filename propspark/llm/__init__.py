"""Operators for large training-data corpora: URL filters, duplicates,
toxicity, decontamination, licences, language-model scores, BPE, shards.

Nothing else in the library imports this subpackage.
"""
