"""Scans: given tables, raw trip files, month manifests, catalog views."""
