"""Readers and writers of the stored layers."""
