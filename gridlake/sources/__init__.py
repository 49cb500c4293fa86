"""Readers and writers for messages, files and catalog tables."""
