"""Readers, harvesters and writers that turn landed raw data into tables."""
