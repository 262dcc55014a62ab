"""Query plans: reports, staging/intermediate/mart models, dashboards, pipeline."""
