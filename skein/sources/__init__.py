"""Sources and sinks: generators, table providers, checked inserts, bound statements."""
