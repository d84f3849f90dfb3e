"""All queries over the image operators."""

from __future__ import annotations

from starloom import queries_align, queries_frames, queries_stack, queries_stencil, queries_tone  # noqa: F401
from starloom.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
