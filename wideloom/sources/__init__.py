"""Readers, bindings of the driver test tables, the cell store and sinks."""
