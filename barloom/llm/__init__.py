"""Operators that prepare training data from documents, pages and labels."""
