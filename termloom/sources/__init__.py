"""Ways to get a corpus: a DataFrame of ``doc`` and ``text``."""
