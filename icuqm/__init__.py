"""Quality measurement over longitudinal intensive-care tables, on Spark."""
