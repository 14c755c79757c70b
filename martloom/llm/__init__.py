"""Operators for preparing training corpora: cleaning, deduplication, decontamination, scoring, packing and sharding.

Nothing else in the library imports this package.
"""
