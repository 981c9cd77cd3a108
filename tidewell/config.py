"""Settings shared by the operators.

The values in this module are fixed: results depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Topic alias -> physical topic.
TOPICS = {
    "events": "raw-events",
    "fraud_scores": "fraud-scores",
    "recommendations": "recommendations",
    "inventory": "inventory-changes",
}

# Milliseconds a topic keeps a record; business-metrics is compacted as well.
RETENTION_MS = {
    "raw-events": 604800000,
    "inventory-changes": 2592000000,
    "fraud-scores": 604800000,
    "recommendations": 86400000,
    "business-metrics": 2592000000,
}

# Event type -> weight of one interaction when scoring recommendations.
INTERACTION_WEIGHTS = {
    "transaction": 1.0,
    "addtocart": 0.7,
    "view": 0.3,
    "search": 0.2,
}
OTHER_INTERACTION_WEIGHT = 0.1

# Event type -> implicit rating in an item vector.
IMPLICIT_RATINGS = {
    "transaction": 5.0,
    "addtocart": 3.0,
    "view": 1.0,
    "search": 0.5,
}
OTHER_IMPLICIT_RATING = 1.0

# Event type -> fields an event of that type has to carry.
REQUIRED_FIELDS = {
    "view": ["timestamp", "user_id", "item_id"],
    "addtocart": ["timestamp", "user_id", "item_id"],
    "transaction": ["timestamp", "user_id", "item_id", "price", "quantity"],
    "search": ["timestamp", "user_id", "search_query"],
    "filter": ["timestamp", "user_id", "filter_type", "filter_value"],
    "review": ["timestamp", "user_id", "item_id", "rating"],
}

EVENT_TYPES = ["view", "addtocart", "transaction", "search", "filter", "review"]
CHANGE_TYPES = ["stock_in", "stock_out", "adjustment", "reservation", "release"]

# Event types a clickstream CSV row may have.
CLICKSTREAM_TYPES = ["view", "addtocart", "transaction"]

BRONZE_START_DATE = "2024-01-01"

FRAUD_CACHE_TTL_S = 86400
RECOMMENDATION_CACHE_TTL_S = 3600
INVENTORY_CACHE_TTL_S = 604800


@dataclass(frozen=True)
class SimilarityConfig:
    k_neighbors: int = 50
    min_common_users: int = 3


@dataclass(frozen=True)
class RecommendConfig:
    top_k: int = 10
    min_interactions: int = 3
    session_gap_minutes: int = 30


@dataclass(frozen=True)
class ForecastConfig:
    """Two component forecasts and how they are blended."""

    periods: int = 7
    min_points: int = 10
    weight_a: float = 0.6
    weight_b: float = 0.4
    band_a: tuple[float, float] = (0.9, 1.1)
    band_b: tuple[float, float] = (0.85, 1.15)
    accuracy_a: float = 0.87
    accuracy_b: float = 0.85


@dataclass(frozen=True)
class StockConfig:
    alert_threshold: float = 100.0
    reorder_point: float = 100.0
    lead_time_days: int = 7


@dataclass(frozen=True)
class FraudConfig:
    threshold: float = 0.85
    min_features: int = 90
    label_cutoff: float = 0.7
    amount_weight: float = 0.4
    amount_scale: float = 5000.0
    velocity_weight: float = 0.6
    velocity_scale: float = 50.0
    trees: int = 100
    depth: int = 10
    seed: int = 42
    inputs: list[str] = field(
        default_factory=lambda: ["amount", "velocity", "country_risk", "is_evening"]
    )


@dataclass(frozen=True)
class StreamConfig:
    """Windows of the streaming jobs; lateness and slide are our choice."""

    tumbling: str = "5 minutes"
    session_gap: str = "30 minutes"
    sliding: str = "24 hours"
    slide: str = "1 hour"
    watermark: str = "10 minutes"
    activity_window: str = "1 day"
    #: Unprocessed records of a topic above which the lag is an alarm.
    lag_alarm: int = 10_000
    trigger_seconds: int = 30
