"""Where records come from: text dumps, text streams, height ranges."""

from blockfee.sources.heights import height_range
from blockfee.sources.lines import line_segments, lines_with, read_lines, stream_lines

__all__ = ["height_range", "line_segments", "lines_with", "read_lines", "stream_lines"]
