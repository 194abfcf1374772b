"""Readers. Each gives a typed DataFrame; none infers a schema unless asked to."""
