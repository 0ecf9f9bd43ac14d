"""Readers, writers and catalog entries of the layers."""
