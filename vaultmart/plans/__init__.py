"""Table-building plans: staging, marts, dashboards and the batch pipeline."""
