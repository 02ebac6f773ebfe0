"""Operators for preparing training text: dedup, scans, packing, tokens, fingerprints."""
