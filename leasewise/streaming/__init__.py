"""Streaming forms of three batch jobs: sessions, landed files, keyed upsert."""
