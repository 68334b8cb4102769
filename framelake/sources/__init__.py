"""Readers, writers and the registries that name them."""
