"""Readers: index catalogs, line frames, audit exports, booking batches, folders, archives."""
