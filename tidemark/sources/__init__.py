"""Readers: binary COPY blobs, replication frames, scan planning."""
