"""Operators of a training-data pipeline: dedup, decontamination, language ID, PII, packing, scoring."""
