"""Operators for building training data: fingerprints, joins, filters, packing, output."""
