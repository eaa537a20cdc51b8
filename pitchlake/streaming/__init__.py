"""Live events: ingest, parse, stateful aggregation, sinks and live queries."""
