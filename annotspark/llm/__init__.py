"""Operators for large text-corpus preparation.  Nothing else in the library imports this subpackage."""
