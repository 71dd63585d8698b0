"""Transit-event analytics as plain DataFrame -> DataFrame functions."""

from railstream.session import configure, scratch_path

__all__ = ["configure", "scratch_path"]
