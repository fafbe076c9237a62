"""Column functions: cleaning, parsing and mapping of messy text."""
