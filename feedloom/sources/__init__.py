"""Readers: change feed, message topic, raw archive and metric log."""
