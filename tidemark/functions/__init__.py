"""Column expressions: type suffixes, object ids, paths, text clean-up."""
