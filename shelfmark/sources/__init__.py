"""Readers, sinks and the versioned snapshot store."""
