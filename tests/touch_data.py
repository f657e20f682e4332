"""Small touch tables for the tests and plain-Python recomputation of what they should give."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from journeyloom.schema import CHANNELS, DEVICES

SCHEMA = (
    "customer_id bigint, session_id string, timestamp timestamp, channel string, device string, "
    "touchpoint_number bigint, total_touchpoints bigint, time_on_site double, pages_viewed int, cost double, "
    "converted int, revenue double"
)

_NINE = [
    (1, 1, 3, "paid_search", 2.5, 0, 0.0, "mobile"),
    (1, 2, 3, "email", 0.1, 0, 0.0, "desktop"),
    (1, 3, 3, "direct", 0.0, 1, 100.0, "mobile"),
    (2, 1, 2, "organic_search", 0.0, 0, 0.0, "desktop"),
    (2, 2, 2, "direct", 0.0, 1, 50.0, "desktop"),
    (3, 1, 4, "social_media", 1.5, 0, 0.0, "mobile"),
    (3, 2, 4, "email", 0.1, 0, 0.0, "tablet"),
    (3, 3, 4, "paid_search", 2.5, 0, 0.0, "desktop"),
    (3, 4, 4, "direct", 0.0, 1, 150.0, "mobile"),
]


def nine_touches(spark):
    start = datetime(2024, 1, 1)
    rows = [
        (c, f"s{i}", start + timedelta(days=i), ch, dev, p, n, 60.0, 3, cost, conv, rev)
        for i, (c, p, n, ch, cost, conv, rev, dev) in enumerate(_NINE)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def random_journeys(lengths, seed=7, conversion=0.5):
    """Rows of numbered touches; customer i has lengths[i] touches, one touch a minute."""
    rng = random.Random(seed)
    rows = []
    for customer, n in enumerate(lengths, 1):
        start = datetime(2024, 1, 1) + timedelta(hours=customer)
        for p in range(1, n + 1):
            hit = rng.random() < conversion / n
            rows.append(
                (
                    customer,
                    f"c{customer}-{p}",
                    start + timedelta(minutes=p),
                    rng.choice(CHANNELS[:5]),
                    rng.choice(DEVICES),
                    p,
                    n,
                    float(rng.randint(10, 300)),
                    rng.randint(1, 9),
                    rng.randint(0, 50) / 10,
                    int(hit),
                    float(rng.randint(1, 400)) if hit else 0.0,
                )
            )
    return rows


def by_touch(df, *columns):
    return {(r["customer_id"], r["touchpoint_number"]): tuple(r[c] for c in columns) for r in df.collect()}
