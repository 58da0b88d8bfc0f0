"""Operators for preparing training text: fingerprints, licence scans, URL filters,
duplicate passages, quality, page text, near duplicates, mixtures, pseudonyms and
benchmark overlap.  Nothing outside this package imports it."""
