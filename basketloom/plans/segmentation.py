"""User segments, aisle bundles and cross-sell lists, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import baskets, cleaning, segments
from ..operators import purchases as buy
from ..schemas import Tables
from ..sources import Stage
from ..sources.staging import fingerprint


def segments_and_bundles(
    tables: Tables,
    stage: Stage,
    k: int = 4,
    restarts: int = 20,
    min_support: float = 0.01,
    min_confidence: float = 0.30,
    min_lift: float = 1.30,
) -> dict[str, DataFrame]:
    """Segments from history; rules from all purchases, target orders included."""
    own = fingerprint(tables)
    clean = cleaning.clean_metadata(tables)
    purchases = stage.table(f"segments-{own}/purchases", lambda: buy.purchase_table(clean))
    targets = buy.target_orders(tables.orders, purchases)
    history = stage.table(f"segments-{own}/history", lambda: buy.history_rows(purchases, targets))
    features = stage.table(
        f"segments-{own}/features", lambda: segments.segment_features(history, tables.orders)
    )
    segmented = stage.table(
        f"segments-{own}/users-{k}-{restarts}", lambda: segments.user_segments(features, k, restarts=restarts)
    )
    weighted = stage.table(
        f"segments-{own}/baskets", lambda: baskets.weighted_baskets(baskets.baskets(purchases))
    )
    rules = baskets.filter_rules(
        baskets.association_rules(weighted), min_support, min_confidence, min_lift
    )
    pairs = baskets.bundle_pairs(rules)
    edges = baskets.bundle_edges(pairs)
    return {
        "elbow": segments.elbow_table(
            segments.scaled_segment_features(features), restarts=restarts
        ),
        "segments": segmented,
        "profile": segments.segment_profile(segmented),
        "rules": rules,
        "bundle_pairs": pairs,
        "bundle_pair_count": baskets.count_bundle_pairs(rules),
        "top_bundles": baskets.top_bundles(pairs),
        "edges": edges,
        "nodes": baskets.bundle_nodes(edges),
        "cross_sell": segments.cross_sell(history, segmented),
    }
