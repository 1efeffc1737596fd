"""Incremental landing: new files of a folder as a stream."""
