"""DataFrame-to-DataFrame steps of the index build."""
