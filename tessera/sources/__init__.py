"""Readers, literal lookups and relations derived from the driver tables."""
