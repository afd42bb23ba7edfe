"""Table constraints."""
