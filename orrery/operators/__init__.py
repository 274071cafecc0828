"""Operators over the three tables: chunking, mapping, rules, reconciling and search."""
