"""Training-data operators: language, HTML, fingerprints, quality, joins, search, mixing, packing."""
