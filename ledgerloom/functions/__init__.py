"""Column-level helpers: predicates, filter lists, rounding, text."""
