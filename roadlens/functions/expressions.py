"""Reusable column expressions: risk rules, rule lists, rounding, draws.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen and works identically in batch and streaming.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

__all__ = [
    "risk_flag_columns",
    "incident_flag_columns",
    "risk_score",
    "rule_list",
    "hash_uniform",
    "profile_effect",
]


def risk_flag_columns() -> dict[str, Column]:
    """The seven scored flags, ``speeding_margin``, ``risk_score_event`` and ``risk_event``.

    Three-valued logic is kept on purpose: a null input makes its flag null,
    the score (a plain sum) null and ``risk_event`` null.
    """
    speed, limit = F.col("speed_kmh"), F.col("speed_limit_kmh")
    flags = {
        "is_speeding": speed > limit + F.lit(C.SPEEDING_TOLERANCE_KMH),
        "speeding_margin": F.greatest(speed - limit, F.lit(0.0)),
        "is_hard_braking": F.col("braking_ms2") < F.lit(C.HARD_BRAKING_MS2),
        "is_harsh_acceleration": F.col("acceleration_ms2") > F.lit(C.HARSH_ACCELERATION_MS2),
        "is_sharp_cornering": F.col("cornering_g") > F.lit(C.SHARP_CORNERING_G),
        "is_night_risk": F.col("is_night") & (speed > limit),
        "is_bad_weather": F.col("weather").isin(*C.BAD_WEATHER),
        "is_phone_usage": F.col("phone_usage"),
    }
    score = risk_score([flags[name] for name in C.SCORE_FLAGS])
    flags["risk_score_event"] = score
    flags["risk_event"] = score > F.lit(0)
    return flags


def risk_score(flags: Sequence[Column]) -> Column:
    total = flags[0].cast("int")
    for flag in flags[1:]:
        total = total + flag.cast("int")
    return total


def incident_flag_columns() -> dict[str, Column]:
    """``is_extreme_braking`` and ``possible_crash_or_incident`` (needs ``is_sharp_cornering``)."""
    extreme = F.col("braking_ms2") < F.lit(C.EXTREME_BRAKING_MS2)
    severe = (
        (F.col("braking_ms2") < F.lit(C.INCIDENT_BRAKING_MS2))
        & (F.col("speed_kmh") > F.lit(C.INCIDENT_SPEED_KMH))
        & F.col("is_sharp_cornering")
    )
    return {"is_extreme_braking": extreme, "possible_crash_or_incident": extreme | severe}


def rule_list(rules: Iterable[tuple[str, str]]) -> Column:
    """Ordered array of the names of the fired rules (null / false flags left out)."""
    arr = F.array(*[F.when(F.col(flag), F.lit(name)) for flag, name in rules])
    return F.filter(arr, lambda x: x.isNotNull())


def hash_uniform(*cols: Column, seed: int = 2026) -> Column:
    """A uniform draw in (0, 1) from the row's key columns: stable under any repartitioning."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.pmod(h, F.lit(1 << 52)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def profile_effect(profile: Column) -> Column:
    """Profile effect on the claim-rate rule; unknown or null profile -> 0.0."""
    mapping = F.create_map(*[x for k, v in C.PROFILE_EFFECT.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(mapping, profile), F.lit(0.0))
