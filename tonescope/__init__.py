"""Tone analytics over large feeds of event records, as Spark DataFrame jobs."""
