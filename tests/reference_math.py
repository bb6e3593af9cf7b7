"""Plain definitions, computed without Spark, to hold the operators against."""

from __future__ import annotations

import math
import random
from decimal import ROUND_HALF_UP, Decimal


def half_up(value, digits):
    exact = Decimal(repr(value)).quantize(Decimal("1e-10"), ROUND_HALF_UP)
    return float(exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def means(users, digits=3):
    return {u: half_up(sum(r.values()) / len(r), digits) for u, r in users.items()}


def pearson(left, right, left_mean, right_mean):
    """Correlation over common items, or None without variance."""
    shared = left.keys() & right.keys()
    dot = sum((left[i] - left_mean) * (right[i] - right_mean) for i in shared)
    a = sum((left[i] - left_mean) ** 2 for i in shared)
    b = sum((right[i] - right_mean) ** 2 for i in shared)
    return dot / math.sqrt(a * b) if a * b > 0 else None


def similarities(users, target, min_common=3):
    mean = means(users)
    found = {}
    for other, items in users.items():
        common = len(users[target].keys() & items.keys())
        if other != target and common >= min_common:
            score = pearson(users[target], items, mean[target], mean[other])
            found[other] = (half_up(score or 0.0, 4), common)
    return found


def pooled(users, target, min_common=3):
    """Every rating of another user against all ratings of the same item."""
    mean = means(users)
    a = mean[target]
    found = {}
    for other, items in users.items():
        if other == target:
            continue
        pairs = [(w[i], r) for i, r in items.items() for w in users.values() if i in w]
        if len(pairs) < min_common:
            continue
        dot = sum((x - a) * (y - mean[other]) for x, y in pairs)
        t = sum((x - a) ** 2 for x, _ in pairs)
        o = sum((y - mean[other]) ** 2 for _, y in pairs)
        found[other] = (half_up(dot / math.sqrt(t * o), 4) if t * o > 0 else 0.0, len(pairs))
    return found


def predictions(users, target, neighbors, digits=2):
    """``{item: (prediction, raters, mean similarity)}`` for unseen items."""
    mean = means(users)
    found = {}
    for item in {i for u in neighbors for i in users[u]} - users[target].keys():
        raters = [u for u in neighbors if item in users[u]]
        weights = sum(abs(neighbors[u]) for u in raters)
        value = None
        if weights:
            shift = sum(neighbors[u] * (users[u][item] - mean[u]) for u in raters) / weights
            value = half_up(min(5.0, max(0.5, mean[target] + shift)), digits)
        average = half_up(sum(neighbors[u] for u in raters) / len(raters), 4)
        found[item] = (value, len(raters), average)
    return found


def random_users(seed, users=30, items=25, share=0.4, everyone=()):
    """Random half-step ratings; items in ``everyone`` are rated by all users."""
    pick = random.Random(seed)
    return {
        u: {
            i: pick.randint(1, 10) / 2
            for i in range(items)
            if i in everyone or pick.random() < share
        }
        or {0: 3.0}
        for u in range(1, users + 1)
    }
