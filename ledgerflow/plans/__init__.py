"""Conformed tables, dimensions, facts and consumer analyses."""
