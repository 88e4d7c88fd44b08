"""Training-data operators: language ID, mixing, quality, WARC, licences, BPE, dedup, extraction.

Nothing else in the library imports this subpackage; its queries are in ``queries``.
"""
