"""Gold tables of random events, missing values included, against plain Python."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from clickstrata.operators import daily, gold
from clickstrata.operators.silver import to_silver
from clickstrata.plans import gold_sql
from clickstrata.schemas import BRONZE, EVENT_TYPES, GOLD
from tests import golden


def random_events(seed, count=600):
    rng = random.Random(seed)

    def maybe(value, share=0.1):
        return None if rng.random() < share else value

    events = []
    for _ in range(count):
        at = dt.datetime(2025, 3, 30) + dt.timedelta(seconds=rng.randrange(3 * 86400))
        text = rng.choice([at.isoformat() + "Z", at.isoformat(timespec="milliseconds") + "+00:00"])
        hot = rng.random() < 0.4
        events.append({
            "timestamp": rng.choice([text] * 9 + [None, "", "soon"]),
            "user_id": maybe("u_0" if hot else f"u_{rng.randrange(40)}"),
            "session_id": maybe(f"s_{rng.randrange(80)}"),
            "event_type": maybe(rng.choice(EVENT_TYPES), 0.05),
            "product_id": maybe("p_1" if hot else f"p_{rng.randrange(6)}"),
            "quantity": maybe(rng.randrange(0, 5)),
            "price": maybe(rng.randrange(1, 30000) / 4),
            "category": maybe(rng.choice(["toys", "books", "größe"])),
            "search_query": None,
        })
    return events


def day_and_hour(event):
    try:
        at = dt.datetime.fromisoformat(event["timestamp"])
    except (TypeError, ValueError):
        return None, None
    return at.date(), f"{at:%Y-%m-%d %H}:00:00"


def expected(events):
    steps = defaultdict(Counter)
    views, categories, purchases = Counter(), Counter(), Counter()
    revenue, totals = defaultdict(list), Counter()
    users, sessions = defaultdict(set), defaultdict(set)
    for event in events:
        day, hour = day_and_hour(event)
        product, kind = (event["product_id"], event["category"]), event["event_type"]
        if kind in ("page_view", "add_to_cart", "purchase"):
            steps[product][kind] += 1
        if kind == "page_view":
            views[product] += 1
        if kind == "purchase":
            purchases[hour] += 1
            if None not in (event["price"], event["quantity"]):
                revenue[hour].append(event["price"] * event["quantity"])
        categories[day, event["category"], kind] += 1
        users[day] |= {event["user_id"]} - {None}
        sessions[day] |= {event["session_id"]} - {None}
        totals[day] += 1

    def ratio(a, b):
        return a / b if b else 0.0

    def funnel(product, counts):
        v, c, p = counts["page_view"], counts["add_to_cart"], counts["purchase"]
        return (*product, v, c, p, ratio(c, v), ratio(p, c), ratio(p, v))

    return {
        "conversion_funnel": {funnel(product, counts) for product, counts in steps.items()},
        # Prices are quarters, so sums are exact in any order.
        "hourly_revenue": {
            (hour, sum(revenue[hour]) if revenue[hour] else None, n)
            for hour, n in purchases.items()
        },
        "product_views": {(*product, n) for product, n in views.items()},
        "category_performance": {(*key, n) for key, n in categories.items()},
        "user_activity": {(d, len(users[d]), len(sessions[d]), n) for d, n in totals.items()},
    }


@pytest.mark.parametrize("seed", range(3))
def test_gold_equals_brute_force(spark, seed):
    events = random_events(seed)
    want = expected(events)
    rows = [tuple(event.get(name) for name in BRONZE.names) for event in events]
    silver = to_silver(spark.createDataFrame(rows, BRONZE)).cache()
    for name in GOLD:
        assert golden.rows(gold.TABLES[name](silver)) == want[name], name
        assert golden.rows(gold_sql.select(spark, name, silver)) == want[name], name
        source, build = daily.FROM_SHARES[name]
        rolled_up = build(golden.shares(silver)[source]).select(GOLD[name].names)
        assert golden.rows(rolled_up) == want[name], name
    silver.unpersist()
