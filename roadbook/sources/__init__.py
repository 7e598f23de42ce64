"""Landed files in, stored tables out."""
