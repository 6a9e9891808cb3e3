"""Click-event analytics on Spark: layered tables, session metrics, funnels, audits."""
