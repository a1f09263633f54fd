"""Bronze to silver to alerts, as one batch plan or per micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RuleConfigA, RuleConfigB, ScaleConfig
from ..operators import enrich, ingest, rules, velocity


@dataclass(frozen=True)
class Dimensions:
    """The slowly moving side of every enrichment."""

    customers: DataFrame
    rates: DataFrame
    risk_countries: DataFrame
    countries: DataFrame | None = None


def typed_amounts(bronze: DataFrame, dims: Dimensions) -> DataFrame:
    """Typed, positive, EUR-converted and dated; no large join yet.

    A batch counts each transaction once, as first delivered. On a stream, where
    "first" needs a watermark, ``windows.unique_transactions`` is the caller's choice.
    """
    typed = enrich.add_calendar(ingest.type_and_reject(bronze))
    if not typed.isStreaming:
        typed = ingest.first_copies(typed)
    return enrich.attach_rate(typed, dims.rates)


def enrich_transactions(
    typed: DataFrame, dims: Dimensions, cfg: RuleConfigA, strict: bool = False
) -> DataFrame:
    """Customer, country and flags on top of ``typed_amounts``."""
    known = enrich.attach_customer(typed, dims.customers, strict)
    located = enrich.attach_country(known, dims.risk_countries, dims.countries)
    return enrich.add_flags(located, cfg)


def build_silver(bronze: DataFrame, dims: Dimensions, cfg: RuleConfigA, strict: bool = False) -> DataFrame:
    return enrich_transactions(typed_amounts(bronze, dims), dims, cfg, strict)


def score_transactions(
    bronze: DataFrame, dims: Dimensions, cfg: RuleConfigA, scale: ScaleConfig = ScaleConfig()
) -> DataFrame:
    """Enriched transactions with trailing velocity.

    Velocity is computed before the customer join: it reads its input three
    times, and this way what it repeats is a scan and a small look-up.
    """
    typed = typed_amounts(bronze, dims)
    moving = velocity.trailing_velocity(typed, cfg, scale.velocity_slice_minutes)
    if cfg.extended:
        moving = velocity.attach_velocity_anomaly(moving, typed, cfg)
    return enrich_transactions(moving, dims, cfg)


def build_alerts(
    bronze: DataFrame,
    dims: Dimensions,
    cfg: RuleConfigA,
    raised_at: Column,
    per_rule: bool = False,
    scale: ScaleConfig = ScaleConfig(),
) -> DataFrame:
    scored = score_transactions(bronze, dims, cfg, scale)
    return rules.raise_alerts(scored, cfg, raised_at, per_rule)


def enrich_pack_b(
    raw: DataFrame,
    customers: DataFrame,
    cfg: RuleConfigB,
    scale: ScaleConfig = ScaleConfig(),
) -> DataFrame:
    """Raw source/destination transactions to scored, prioritised ones.

    ``customers`` has one row per customer with ``avg_transaction_amount``,
    ``is_pep`` and ``risk_score``.
    """
    moving = velocity.trailing_sums(
        raw,
        {"rolling_24h_count": F.lit(1).cast("bigint")},
        hours=cfg.velocity_window_hours,
        slice_minutes=scale.velocity_slice_minutes,
    )
    known = moving.join(
        customers.select("customer_id", "avg_transaction_amount", "is_pep", "risk_score"),
        "customer_id",
        "left",
    )
    return rules.score_pack_b(rules.evaluate_pack_b(rules.add_pack_b_features(known, cfg), cfg), cfg)
