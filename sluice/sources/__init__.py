"""Index pages, landing folders and archives."""
