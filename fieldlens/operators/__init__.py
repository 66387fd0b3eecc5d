"""Reusable relational operators: size-checked broadcast, NULL-key-aside left join,
day-expanded range join, post-image updates and unique-key splits."""
