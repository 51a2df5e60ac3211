"""Intake, enrichers, merge into the document store, comparison."""
