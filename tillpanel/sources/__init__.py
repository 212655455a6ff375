"""Readers and writers: panel tables, derived driver tables, snapshots, logs."""
