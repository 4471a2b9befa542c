"""Readers and writers for metric files, range-query responses and exposition lines."""
