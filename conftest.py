"""Puts the repository root on the import path for the tests."""
