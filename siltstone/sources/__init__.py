"""Readers for directories of compressed text."""
