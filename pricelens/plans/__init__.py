"""Composed plans: driver-table bindings, end-to-end pipelines, query catalog."""
