"""Readers, landed-payload parsers and writers."""
