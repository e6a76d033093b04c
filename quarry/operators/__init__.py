"""The jobs.  Each function takes DataFrames and parameters and returns a
DataFrame; none starts a session or collects data to the driver."""
