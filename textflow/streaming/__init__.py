"""The streams: intake, dispatch, enrichment, merge, and a view for debugging."""
