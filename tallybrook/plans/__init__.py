"""The bronze, silver and gold models, their quality suites, and ad-hoc reports."""
