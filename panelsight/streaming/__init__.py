"""Structured Streaming entry points (stateless scoring of landing files)."""

from panelsight.streaming.scoring import score_landing_folder, scored_stream  # noqa: F401
