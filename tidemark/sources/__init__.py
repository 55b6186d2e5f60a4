"""Readers: lake tables, serving collections, CSV feeds, listings, JDBC, metadata documents."""
