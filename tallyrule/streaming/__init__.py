"""Incremental form of the cluster job on Structured Streaming."""

from tallyrule.streaming.clusters import stream_clusters

__all__ = ["stream_clusters"]
