"""The library's operators bound to the given tables, with their reference SQL."""
