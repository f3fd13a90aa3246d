"""Relational operators over sketch hashes, queues and listings."""
