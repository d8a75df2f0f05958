"""Inputs: raw tables, staging projections, load strategies, audit log."""
