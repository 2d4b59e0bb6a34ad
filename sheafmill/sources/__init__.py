"""Table readers, writers and fitted-model storage."""
