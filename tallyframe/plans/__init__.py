"""The analyses, one function each, from typed tables to a result table."""
