"""Operators for training data: token counts, filters, classifiers, near copies, archives."""
