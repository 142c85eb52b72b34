"""Diagnostic operators for data-platform metadata, as DataFrame-to-DataFrame functions."""

__version__ = "0.1.0"
