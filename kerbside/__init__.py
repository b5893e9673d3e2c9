"""City sensor telemetry on Spark: raw, cleaned and KPI layers, alerts and a PM2.5 model."""
