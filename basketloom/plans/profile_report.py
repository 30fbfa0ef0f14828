"""Profiling of the cleaned tables and of the target/history split, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import cleaning, profiling
from ..operators import purchases as buy
from ..schemas import Tables
from ..sources import Stage
from ..sources.staging import fingerprint


def profile_report(tables: Tables, stage: Stage) -> dict[str, DataFrame]:
    """Every profiling table by name. Purchases, history and target rows are staged once."""
    own = fingerprint(tables)
    clean = cleaning.clean_metadata(tables)
    purchases = stage.table(f"profile-{own}/purchases", lambda: buy.purchase_table(clean))
    targets = stage.table(f"profile-{own}/targets", lambda: buy.target_orders(tables.orders, purchases))
    history = stage.table(f"profile-{own}/history", lambda: buy.history_rows(purchases, targets))
    target = stage.table(f"profile-{own}/target", lambda: buy.target_rows(purchases, targets))
    orders = cleaning.fill_nulls(tables.orders, {"days_since_prior_order": 0.0})
    counts, pairs = profiling.user_order_counts(orders), profiling.pair_counts(history)
    sizes, widths = profiling.basket_sizes(target), profiling.candidate_sizes(history)
    products = profiling.product_popularity(history)
    departments = profiling.department_summary(history)
    aisles = profiling.aisle_summary(history)
    draw = profiling.distribution
    return {
        "missing_report": cleaning.missing_report(tables),
        "null_profile": cleaning.null_profile(
            {"orders": tables.orders, "prior": clean.prior, "train": clean.train}
        ),
        "null_pattern": cleaning.null_pattern(tables.orders),
        "audit": cleaning.table_audit({**dict(clean.items()), "purchases": purchases}),
        "orders_by_eval_set": profiling.category_shares(orders, "eval_set"),
        "users_by_eval_set": profiling.category_shares(buy.last_orders(orders), "eval_set"),
        "targets_by_eval_set": profiling.category_shares(targets, "eval_set"),
        "prior_lines_by_group": profiling.line_share_by_group(clean.prior, orders),
        "coverage": profiling.order_count_coverage(orders),
        "eligible_users": buy.eligible_users(history),
        "tails": profiling.long_tail_summary(orders, history, target),
        "basket_sizes": profiling.basket_size_stats(target),
        "recency_curve": profiling.recency_curve(history, target, targets),
        "count_of_counts": profiling.count_of_counts(pairs),
        "busiest_hours": profiling.busiest_hours(orders),
        "gap_quantiles": profiling.gap_quantiles(orders),
        "product_quantiles": profiling.product_popularity_quantiles(history),
        "departments": departments,
        "aisles": aisles,
        "top_aisles_by_count": profiling.top_aisles_by_count(history),
        "top_aisles_by_reorder": profiling.top_aisles_by_reorder(history),
        "hist_user_orders": draw(counts, "u_all_orders"),
        "hist_basket_size": draw(sizes, "basket_size"),
        "hist_candidate_size": draw(widths, "n_products"),
        "hist_hours": profiling.orders_by_hour(orders),
        "hist_gap_days": draw(orders, "days_since_prior_order", 31),
        "hist_product_purchases": draw(products, "p_total_purchases", 80, log1p=True),
        "hist_product_reorder": draw(products, "p_reorder_ratio", 60),
        "hist_department_purchases": draw(departments, "purchase_count", 30, log1p=True),
        "hist_department_reorder": draw(departments, "reorder_ratio", 20),
        "hist_aisle_purchases": draw(aisles, "purchase_count", 40, log1p=True),
        "hist_aisle_reorder": draw(aisles, "reorder_ratio", 30),
    }
