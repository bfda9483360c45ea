"""Readers and writers for flat files, vocabularies, seeds and variant pages."""
