"""Readers and writers: raw archive, message bus, tables, high-water mark."""
