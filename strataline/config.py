"""Settings of a profile: which of the four rule sets the operators follow."""

from __future__ import annotations

from dataclasses import dataclass, field

from strataline.functions import lexicon


@dataclass(frozen=True)
class Profile:
    max_buffer: int = 15
    short_words: int = 50
    max_words: int = 500
    overlap: int = 2
    page_width: float = 612.0
    page_height: float = 792.0
    column_share: float = 0.45
    isolate_columns: bool = True
    merge_guard: bool = True
    id_gap: int = 8
    top_band: float = 0.08
    bottom_band: float = 0.08
    side_band: float = 0.05
    hard_band: bool = True
    furniture_words: int = 8
    furniture_share: float = 0.20
    furniture_pages: int = 10
    furniture_types: tuple[str, ...] = ("Header", "Paragraph", "Text", "ListItem")
    full: float = 0.7
    partial: float = 0.4
    caption_distance: float = 0.25
    caption_overlap: float = 0.3
    weights: dict = field(default_factory=lambda: dict(lexicon.CONTINUATION_WEIGHTS))
    rich_rules: bool = True  # alignment, absorption, formula chunks, spatial check and sticky buffers


CANONICAL = Profile()
EMBEDDING = Profile(
    max_buffer=5, top_band=0.10, bottom_band=0.10, side_band=0.0, hard_band=False, furniture_words=5, furniture_types=("Header", "Paragraph", "Text"), partial=0.45, isolate_columns=False, merge_guard=False
)
LEGACY = Profile(max_buffer=5, weights=dict(lexicon.CONTINUATION_WEIGHTS_LEGACY), rich_rules=False)
PROFILES = {"canonical": CANONICAL, "embedding": EMBEDDING, "legacy": LEGACY}
