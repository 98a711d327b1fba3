"""Relational, quality, load, reconciliation and reporting operators."""
