"""Complete plans built from the operators: curated snapshot, quality gate, forecast, clusters, alerts."""
