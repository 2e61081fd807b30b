"""Reading and publishing tables, documents and listings."""
