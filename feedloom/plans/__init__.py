"""Composed plans: collection tables, metrics, dashboards, alerts and replay."""
