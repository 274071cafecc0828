"""Table schemas, documents and their units."""
