"""Composite jobs: the wide-table sections, the wide build, the cells
round trip, typed export, document load and calendar dimensions."""
