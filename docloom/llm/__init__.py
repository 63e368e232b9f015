"""Operators for training data: mixing, extraction, scoring, deduplication, packing and licence scans."""
