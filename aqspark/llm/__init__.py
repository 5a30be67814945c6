"""Operators for preparing text corpora: deduplication, decontamination, classifiers, packing, sharding, scans."""
