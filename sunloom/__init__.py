"""Space-weather time-series and image-catalogue jobs on Spark."""
