"""Plans: the end-to-end build and the registered query catalogue."""

from .build import BuildResult, build_index

__all__ = ["BuildResult", "build_index"]
