"""Match-data analytics on Spark: cleaning, modelling, history, quality tests and live events."""
