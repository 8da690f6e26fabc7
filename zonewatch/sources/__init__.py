"""Readers for raw files, stored tables and message streams."""
