"""Readers, writers, table checkpoints and the flight-record preset."""
