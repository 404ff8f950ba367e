"""Jobs built from operators, and the catalogue of named queries."""
