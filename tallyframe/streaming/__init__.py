"""Structured Streaming: camera frames to detections, detections to the stored table, live figures."""
