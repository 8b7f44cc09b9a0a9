"""Operators for preparing training data: filters, joins, packing, scoring and archives."""
