"""Keyword arrays."""

#: The keyword of a row that has none of the words.
UNKNOWN = "unknown"
