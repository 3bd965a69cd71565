"""Queries over the invoice model and their SQL."""
