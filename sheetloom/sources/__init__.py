"""Readers: files, sheet bundles, scraped pages and service responses."""
