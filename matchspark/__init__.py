"""Match-outcome feature tables, profiling and modelling expressed as Spark jobs."""
