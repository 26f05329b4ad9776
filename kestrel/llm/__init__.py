"""Operators for training-data corpora: deduplication, language identification, sharding,
fingerprints, secret, toxicity, contamination and license scans, tokenizing, and LM scoring.

Nothing outside this subpackage imports it.
"""
