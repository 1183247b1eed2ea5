"""Table maintenance, layout audits and the layer jobs."""
