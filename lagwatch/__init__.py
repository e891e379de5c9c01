"""lagwatch: consumer-lag metrics, anomaly rules and alert views as Spark jobs."""
