"""Operators for preparing training data: archives, filters, duplicates, packing, classifiers."""
