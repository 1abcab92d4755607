"""Readers. Every reader returns a lazy DataFrame; nothing is pulled through the driver."""
