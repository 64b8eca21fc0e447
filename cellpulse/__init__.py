"""KPI analytics for mobile networks, written as Spark jobs."""
