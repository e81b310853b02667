"""Training-data operators: deduplication, filtering, mixing, search and output formats.

Nothing outside this subpackage imports it; ``registry`` holds its registered queries."""
