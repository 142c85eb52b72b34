"""Diagnoses that read query-plan text."""
