"""tripspot: trip demand, hotspot scores and forecasts as plain PySpark jobs."""
