"""Readers for annotation sets, prediction files and media listings."""
