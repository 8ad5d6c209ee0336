"""Operators for preparing a text corpus. Nothing else in the library imports this subpackage."""
