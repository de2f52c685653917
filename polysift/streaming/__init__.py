"""Prediction files and events as streams."""
