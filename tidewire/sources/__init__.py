"""Readers and parsers of feeds, pages, payloads, registries and indexes."""
