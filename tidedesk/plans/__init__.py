"""Ready-made chains: the full run, the test views and the query catalogue."""
