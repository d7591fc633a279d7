"""The results as Structured Streaming queries: sources in, sinks out, state in between."""
