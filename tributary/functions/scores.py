"""Probabilities and losses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blend(ce: Column, first: Column, second: Column, weights: tuple[float, float, float] = (0.5, 0.25, 0.25)) -> Column:
    """Weighted mean of three probabilities, of the last two where the first is null or NaN, within 0 and 1.

    Weights are normalised among those that take part; weights without a positive sum count as equal.
    """

    def mean(parts: list[tuple[Column, float]]) -> Column:
        total = sum(w for _, w in parts)
        shares = [w / total if total > 0 else 1 / len(parts) for _, w in parts]
        out = F.lit(0.0)
        for (value, _), share in zip(parts, shares):
            out = out + value * F.lit(float(share))
        return out

    w = [float(x) for x in weights]
    missing = ce.isNull() | F.isnan(ce)
    value = F.when(missing, mean([(first, w[1]), (second, w[2])])).otherwise(mean([(ce, w[0]), (first, w[1]), (second, w[2])]))
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def focal_loss(logit: Column, target: Column, gamma: float = 2.0, alpha: float = 0.25) -> Column:
    """Binary focal loss of one row: alpha_t (1 - p_t)^gamma times the cross entropy. Aggregate it with avg or sum."""
    entropy = F.greatest(logit, F.lit(0.0)) - logit * target + F.log1p(F.exp(-F.abs(logit)))
    p = F.exp(-entropy)
    share = target * F.lit(alpha) + (1 - target) * F.lit(1 - alpha)
    return share * F.pow(1 - p, F.lit(gamma)) * entropy
