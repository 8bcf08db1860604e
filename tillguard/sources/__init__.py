"""Readers: batch tables, JSON event decoding, keyed changelogs, fixtures."""
