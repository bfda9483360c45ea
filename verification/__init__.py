"""Every operator run over the test tables, and the same result in plain SQL."""
