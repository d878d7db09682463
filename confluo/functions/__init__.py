"""Column functions: standardisation, masks, scores."""
