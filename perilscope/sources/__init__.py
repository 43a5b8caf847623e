"""Readers and writers: raw event files, price index, census files, seeds, warehouse tables."""
