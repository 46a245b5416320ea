"""Operators for preparing training data: dedup, mixing, quality, chat, secrets, language, BPE, PII, WARC.

Nothing else in the library imports this subpackage.
"""
