"""Corpus statistics, each a function from DataFrame to lazy DataFrame."""
