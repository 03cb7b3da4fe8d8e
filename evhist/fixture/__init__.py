"""Test feed: the documents that the registered queries run on, derived from ``events``."""
