"""hourlens: table-to-table operators for hourly observation data on Spark."""
