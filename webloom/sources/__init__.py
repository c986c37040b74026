"""Readers for record containers, side-input lines and the tabular demo crawl."""
