"""Monitoring over the prediction log: windowed aggregates that run the same
on a batch DataFrame and on a Structured Streaming DataFrame."""
