"""Layer plans: bronze, silver, gold, reports, quality and the full run."""
