"""Line sources (text scans, type tagging) and feeds rendered from the given tables."""

from .lines import filter_long_lines, read_index_inputs, read_lines, read_typed, write_lines

__all__ = ["filter_long_lines", "read_index_inputs", "read_lines", "read_typed", "write_lines"]
