"""The rules in plain Python, as brute-force counterpart of the Spark plans."""

import math
from collections import defaultdict

# Limits per measure: green from, green to, yellow from, yellow to; then prefix and noun.
RULES = {
    "temperature": (45, 47, 44, 48, "temp", "temperature"),
    "pressure": (60, 70, 58, 72, "pressure", "pressure"),
    "motor_power": (11, 13, 9, 15, "mpower", "motor power"),
}


def colour(measure, x):
    g1, g2, y1, y2, *_ = RULES[measure]
    if g1 <= x <= g2:
        return "green"
    if y1 <= x < g1 or g2 < x <= y2:
        return "yellow"
    return "red"


def alerts(rows, seconds=60):
    """``{(window start in epoch seconds, measure): (mean, status)}`` for
    ``(epoch seconds, {measure: value})`` rows."""
    values = defaultdict(list)
    for at, measures in rows:
        if at is None:
            continue
        for measure, value in measures.items():
            if value is not None:
                values[math.floor(at / seconds) * seconds, measure].append(value)
    out = {}
    for key, found in values.items():
        mean = math.fsum(found) / len(found)
        out[key] = (mean, f"{RULES[key[1]][4]}_{colour(key[1], mean)}")
    return out
