"""Query plans: analytics views, measures, warehouse runs."""
