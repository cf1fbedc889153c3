"""DataFrame to DataFrame steps: validate, enrich, deduplicate, model, check."""
