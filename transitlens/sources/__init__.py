"""Readers and writers (files only; no network clients)."""
