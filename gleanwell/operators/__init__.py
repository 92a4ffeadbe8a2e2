"""DataFrame -> DataFrame steps; compose them with ``df.transform``."""
