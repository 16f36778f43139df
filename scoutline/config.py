"""Settings as frozen dataclasses; their values become literals in the plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from scoutline import fixed


@dataclass(frozen=True)
class Discovery:
    keywords: tuple[str, ...] = fixed.SEARCH_KEYWORDS
    page_size: int = 50
    target: int | None = None
    region_code: str | None = "IN"
    language: str | None = "en"


@dataclass(frozen=True)
class Enrichment:
    recent_videos: int = 10


@dataclass(frozen=True)
class ScoreWeights:
    followers: float = 0.20
    engagement: float = 0.35
    niche: float = 0.25
    activity: float = 0.20


@dataclass(frozen=True)
class Rules:
    min_followers: int = 5000
    max_followers: int = 100000
    min_engagement_rate: float = 0.01
    min_keyword_hits: int = 2
    max_upload_age_days: int = 90
    engagement_score_cap: float = 0.05
    weights: ScoreWeights = field(default_factory=ScoreWeights)
    niche_keywords: tuple[str, ...] = fixed.NICHE_KEYWORDS


@dataclass(frozen=True)
class Angles:
    high_engagement_rate: float = 0.04
    mid_engagement_rate: float = 0.02
    high_reach_followers: int = 50000
    high_reach_views: int = 10000
    high_engagement: str = fixed.HIGH_ENGAGEMENT_ANGLE
    mid_engagement: str = fixed.MID_ENGAGEMENT_ANGLE
    high_reach: str = fixed.HIGH_REACH_ANGLE
    default: str = fixed.DEFAULT_ANGLE


@dataclass(frozen=True)
class DraftLimits:
    subject_max_words: int = 8
    email_words: tuple[int, int] = (60, 90)
    dm_words: tuple[int, int] = (15, 30)
    max_attempts: int = 3
    max_calls: int = 3
    retry_base_delay: float = 1.0


@dataclass(frozen=True)
class Brand:
    name: str = fixed.BRAND_NAME
    product: str = fixed.BRAND_PRODUCT
    value_prop: str = fixed.VALUE_PROPOSITION
    placeholders: tuple[str, ...] = (fixed.BRAND_NAME, fixed.BRAND_PRODUCT)


@dataclass(frozen=True)
class Settings:
    discovery: Discovery = field(default_factory=Discovery)
    enrichment: Enrichment = field(default_factory=Enrichment)
    rules: Rules = field(default_factory=Rules)
    angles: Angles = field(default_factory=Angles)
    drafts: DraftLimits = field(default_factory=DraftLimits)
    brand: Brand = field(default_factory=Brand)
