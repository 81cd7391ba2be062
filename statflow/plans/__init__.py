"""Composite jobs: the five statistics tables, landings, reports, and the
registered queries over the driver tables."""
