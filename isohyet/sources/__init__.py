"""Readers, sinks and the manifest and registry tables."""
