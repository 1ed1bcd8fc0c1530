"""galesol: weather-to-power indicators and corpus preparation as Spark DataFrame jobs."""
