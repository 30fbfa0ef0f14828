"""The registered queries: every operator applied to a warehouse folder."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import affinity, baskets, cleaning, evaluation, features, models, profiling
from ..operators import purchases as buy
from ..operators import segments as seg
from ..sources import read_warehouse, stage_for
from ..sources.staging import WarehouseStage
from . import next_order

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered runs (shared with the oracles).
RULE_THRESHOLDS = {"min_support": 0.01, "min_confidence": 0.10, "min_lift": 0.90}
THRESHOLDS = [0.05, 0.1, 0.2, 0.3, 0.5]
SCORE_MODELS = ["frequency", "recency", "repeat"]
SCORE_PREFERENCE = ["recency", "frequency"]

_QUERIES: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def query(run: Callable[[WarehouseStage], DataFrame]) -> Callable:
    """Register a function of the staged inputs under its own name."""
    _QUERIES[run.__name__] = lambda spark, folder: run(stage_for(spark, folder))
    return run


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that results do not depend on the order of summation."""
    return df.select(
        *[
            (F.round(c, digits) + 0.0).alias(c) if kind in ("double", "float") else F.col(c)
            for c, kind in df.dtypes
        ]
    )


# --- staged intermediates ----------------------------------------------------------------------


def cleaned(s: WarehouseStage):
    return cleaning.clean_metadata(s.tables())


def purchases(s: WarehouseStage) -> DataFrame:
    return s.table("purchases", lambda: buy.purchase_table(cleaned(s)))


def targets(s: WarehouseStage) -> DataFrame:
    return s.table("targets", lambda: buy.target_orders(s.orders, purchases(s)))


def history(s: WarehouseStage) -> DataFrame:
    return s.table("history", lambda: buy.history_rows(purchases(s), targets(s)))


def target(s: WarehouseStage) -> DataFrame:
    return s.table("target", lambda: buy.target_rows(purchases(s), targets(s)))


def pair_totals(s: WarehouseStage) -> DataFrame:
    return next_order.staged_pairs(s.tables(), s)


def candidates(s: WarehouseStage) -> DataFrame:
    return next_order.staged_candidates(s.tables(), s, with_affinity=False)


def affinities(s: WarehouseStage) -> DataFrame:
    return next_order.staged_affinity(s.tables(), s)


def full_candidates(s: WarehouseStage) -> DataFrame:
    """Candidates with the affinity features."""
    return next_order.staged_candidates(s.tables(), s)


def validation(s: WarehouseStage) -> DataFrame:
    return features.split_by_user(candidates(s))[1]


def simple_scores(s: WarehouseStage) -> DataFrame:
    """Three scores that SQL can state: (model, user_id, product_id, label, prob)."""
    kinds = {
        "frequency": F.col("up_freq"),
        "recency": 1.0 / (1.0 + F.col("up_orders_since_last")),
        "repeat": F.col("up_reorder_ratio"),
    }
    rows = F.array(
        *[F.struct(F.lit(m).alias("model"), kinds[m].alias("prob")) for m in SCORE_MODELS]
    )
    return validation(s).select("user_id", "product_id", "label", F.inline(rows))


def frequency_scores(s: WarehouseStage) -> DataFrame:
    return simple_scores(s).where("model = 'frequency'").drop("model")


def scored_orders(s: WarehouseStage) -> DataFrame:
    return evaluation.validation_orders(s.orders)


def truth(s: WarehouseStage) -> DataFrame:
    return evaluation.true_products(s.train)


def stage_inputs(spark: SparkSession, folder: str) -> Iterator[tuple[str, float]]:
    """Write every staged table in turn; yields its name and the seconds it took."""
    s = stage_for(spark, folder)
    builders = {
        "orders": lambda: s.orders,
        "lines": lambda: s.lines,
        "products": lambda: s.products,
        "aisles": lambda: s.aisles,
        "departments": lambda: s.departments,
        "purchases": lambda: purchases(s),
        "targets": lambda: targets(s),
        "history": lambda: history(s),
        "target": lambda: target(s),
        "pair_totals": lambda: pair_totals(s),
        "candidates": lambda: candidates(s),
        "affinity": lambda: affinities(s),
        "full_candidates": lambda: full_candidates(s),
        "segment_features": lambda: _segment_features(s),
        "segments": lambda: _segments(s),
    }
    for name, build in builders.items():
        start = time.perf_counter()
        build()
        yield name, time.perf_counter() - start


# --- sources, cleaning -------------------------------------------------------------------------


@query
def scan_orders(s: WarehouseStage) -> DataFrame:
    return read_warehouse(s.spark, s.folder).orders


@query
def scan_order_lines(s: WarehouseStage) -> DataFrame:
    fresh = read_warehouse(s.spark, s.folder)
    return buy.union_lines(fresh.prior, fresh.train)


@query
def scan_catalog(s: WarehouseStage) -> DataFrame:
    fresh = read_warehouse(s.spark, s.folder)
    joined = fresh.products.join(fresh.aisles, "aisle_id", "left")
    return joined.join(fresh.departments, "department_id", "left").select(
        "product_id", "product_name", "aisle_id", "department_id", "aisle", "department"
    )


@query
def table_preview(s: WarehouseStage) -> DataFrame:
    return cleaning.preview(s.orders, ["order_id"])


@query
def numeric_describe(s: WarehouseStage) -> DataFrame:
    frames = {
        "orders": (s.orders, [c for c in s.orders.columns if c != "eval_set"]),
        "prior": (s.prior, s.prior.columns),
        "train": (s.train, s.train.columns),
    }
    return rounded(cleaning.describe_numeric(frames), 4)


@query
def null_profile(s: WarehouseStage) -> DataFrame:
    return cleaning.null_profile({"orders": s.orders, "prior": s.prior, "train": s.train})


@query
def table_audit(s: WarehouseStage) -> DataFrame:
    frames = dict(s.tables().items())
    return cleaning.table_audit({**frames, "purchases": purchases(s)})


@query
def lenient_cast(s: WarehouseStage) -> DataFrame:
    order, product = F.col("order_id").cast("string"), F.col("product_id").cast("string")
    dirty = s.prior.select(
        F.when(F.col("order_id") % 10 == 0, F.concat(F.lit("x"), order))
        .when(F.col("order_id") % 10 == 1, F.concat(order, F.lit(".0")))
        .otherwise(order)
        .alias("order_id"),
        F.when(F.col("product_id") % 10 == 3, F.lit("")).otherwise(product).alias("product_id"),
    )
    return cleaning.lenient_keys(dirty, ["order_id", "product_id"])


@query
def fill_nulls(s: WarehouseStage) -> DataFrame:
    return cleaning.fill_nulls(s.orders, {"days_since_prior_order": 0.0}).select(
        "order_id", "days_since_prior_order"
    )


@query
def scrub_nonfinite(s: WarehouseStage) -> DataFrame:
    broken = s.orders.select(
        "order_id",
        F.when(F.col("order_id") % 5 == 0, F.lit(float("nan")))
        .when(F.col("order_id") % 5 == 1, F.lit(float("inf")))
        .when(F.col("order_id") % 5 == 2, F.lit(float("-inf")))
        .otherwise(F.col("days_since_prior_order"))
        .alias("gap"),
    )
    return cleaning.scrub_nonfinite(broken, ["gap"])


@query
def missing_report(s: WarehouseStage) -> DataFrame:
    return cleaning.missing_report(s.tables())


@query
def clean_products(s: WarehouseStage) -> DataFrame:
    return cleaned(s).products


@query
def clean_aisles(s: WarehouseStage) -> DataFrame:
    return cleaned(s).aisles


@query
def clean_departments(s: WarehouseStage) -> DataFrame:
    return cleaned(s).departments


@query
def clean_lines(s: WarehouseStage) -> DataFrame:
    tables = cleaned(s)
    return buy.union_lines(tables.prior, tables.train)


@query
def null_pattern_check(s: WarehouseStage) -> DataFrame:
    return cleaning.null_pattern(s.orders)


# --- purchases, target and history -------------------------------------------------------------


@query
def enriched_lines(s: WarehouseStage) -> DataFrame:
    return buy.purchase_table(cleaned(s))


@query
def user_timeline(s: WarehouseStage) -> DataFrame:
    return buy.with_cumulative_days(s.orders).select(
        "order_id", "user_id", "order_number", "user_cum_days"
    )


@query
def user_last_day(s: WarehouseStage) -> DataFrame:
    return buy.last_cumulative_day(buy.with_cumulative_days(s.orders))


@query
def last_order(s: WarehouseStage) -> DataFrame:
    return buy.last_orders(s.orders).select("user_id", "order_id", "order_number", "eval_set")


@query
def target_orders(s: WarehouseStage) -> DataFrame:
    return buy.target_orders(s.orders, purchases(s))


@query
def target_history_split(s: WarehouseStage) -> DataFrame:
    return buy.with_target_flag(purchases(s), targets(s)).select(
        "order_id", "product_id", "user_id", "target_order_id", "is_target_order"
    )


@query
def target_lines(s: WarehouseStage) -> DataFrame:
    return buy.target_rows(purchases(s), targets(s)).select("order_id", "product_id", "user_id")


@query
def history_lines(s: WarehouseStage) -> DataFrame:
    return buy.history_rows(purchases(s), targets(s)).select("order_id", "product_id", "user_id")


@query
def eligible_users(s: WarehouseStage) -> DataFrame:
    return buy.eligible_users(history(s))


# --- features ----------------------------------------------------------------------------------


def _pairs(s: WarehouseStage) -> tuple[DataFrame, DataFrame]:
    timeline = buy.with_cumulative_days(s.orders)
    pairs = features.pair_totals(features.prior_details(s.tables(), timeline))
    return pairs, buy.last_cumulative_day(timeline)


@query
def user_features(s: WarehouseStage) -> DataFrame:
    return rounded(features.user_features(*_pairs(s)))


@query
def product_features(s: WarehouseStage) -> DataFrame:
    return rounded(features.product_features(_pairs(s)[0]))


@query
def pair_features(s: WarehouseStage) -> DataFrame:
    pairs, days = pair_totals(s), _pairs(s)[1]
    return rounded(features.pair_features(pairs, features.user_features(pairs, days)))


@query
def labels(s: WarehouseStage) -> DataFrame:
    return features.label_pairs(s.train, s.orders)


@query
def candidate_table(s: WarehouseStage) -> DataFrame:
    full = features.candidate_table(s.tables(), pairs=pair_totals(s))
    return rounded(full.drop(*features.AFFINITY_FEATURES))


@query
def labelled_candidates(s: WarehouseStage) -> DataFrame:
    full = features.candidate_table(
        s.tables(), labelled_users_only=True, pairs=pair_totals(s)
    )
    return full.select("user_id", "product_id", "up_buy_cnt", "label")


@query
def user_split(s: WarehouseStage) -> DataFrame:
    users = candidates(s).select("user_id").distinct()
    return users.withColumn("is_validation", features.is_validation_user(F.col("user_id")))


@query
def positive_rate(s: WarehouseStage) -> DataFrame:
    return rounded(features.positive_rate(candidates(s)))


# --- profiling ---------------------------------------------------------------------------------


@query
def eval_set_shares(s: WarehouseStage) -> DataFrame:
    scopes = {
        "orders": s.orders,
        "users": buy.last_orders(s.orders),
        "target_orders": targets(s),
    }
    return cleaning.union_all(
        profiling.category_shares(df, "eval_set").withColumn("scope", F.lit(scope))
        for scope, df in scopes.items()
    )


@query
def eval_sets_per_user(s: WarehouseStage) -> DataFrame:
    sets = profiling.eval_sets_per_user(s.orders)
    return sets.select("user_id", F.array_join("eval_sets", ",").alias("eval_sets"))


@query
def line_share_by_group(s: WarehouseStage) -> DataFrame:
    tables = cleaned(s)
    return cleaning.union_all(
        profiling.line_share_by_group(lines, s.orders).withColumn("source", F.lit(source))
        for source, lines in (("prior", tables.prior), ("train", tables.train))
    )


@query
def order_count_coverage(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.order_count_coverage(s.orders))


@query
def user_order_counts(s: WarehouseStage) -> DataFrame:
    return profiling.user_order_counts(s.orders)


@query
def tail_summary(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.long_tail_summary(s.orders, history(s), target(s)))


@query
def basket_sizes(s: WarehouseStage) -> DataFrame:
    return profiling.basket_sizes(target(s))


@query
def basket_size_stats(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.basket_size_stats(target(s)))


@query
def hist_user_orders(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.distribution(profiling.user_order_counts(s.orders), "u_all_orders"))


@query
def hist_basket_size(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.distribution(profiling.basket_sizes(target(s)), "basket_size"))


@query
def hist_candidate_size(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.distribution(profiling.candidate_sizes(history(s)), "n_products"))


@query
def hist_gap_days(s: WarehouseStage) -> DataFrame:
    filled = cleaning.fill_nulls(s.orders, {"days_since_prior_order": 0.0})
    return rounded(profiling.distribution(filled, "days_since_prior_order", 31))


@query
def hist_product_purchases(s: WarehouseStage) -> DataFrame:
    products = profiling.product_popularity(history(s))
    return rounded(profiling.distribution(products, "p_total_purchases", 80, log1p=True))


@query
def hist_product_reorder(s: WarehouseStage) -> DataFrame:
    products = profiling.product_popularity(history(s))
    return rounded(profiling.distribution(products, "p_reorder_ratio", 60))


@query
def hist_department_purchases(s: WarehouseStage) -> DataFrame:
    summary = profiling.department_summary(history(s))
    return rounded(profiling.distribution(summary, "purchase_count", 30, log1p=True))


@query
def hist_department_reorder(s: WarehouseStage) -> DataFrame:
    summary = profiling.department_summary(history(s))
    return rounded(profiling.distribution(summary, "reorder_ratio", 20))


@query
def hist_aisle_purchases(s: WarehouseStage) -> DataFrame:
    summary = profiling.aisle_summary(history(s))
    return rounded(profiling.distribution(summary, "purchase_count", 40, log1p=True))


@query
def hist_aisle_reorder(s: WarehouseStage) -> DataFrame:
    summary = profiling.aisle_summary(history(s))
    return rounded(profiling.distribution(summary, "reorder_ratio", 30))


@query
def count_of_counts(s: WarehouseStage) -> DataFrame:
    return profiling.count_of_counts(profiling.pair_counts(history(s)))


@query
def candidate_size(s: WarehouseStage) -> DataFrame:
    return profiling.candidate_sizes(history(s))


@query
def candidate_size_quantiles(s: WarehouseStage) -> DataFrame:
    sizes = profiling.candidate_sizes(history(s))
    return rounded(profiling.plot_quantiles(sizes, "n_products", sizes=True))


@query
def recency_curve(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.recency_curve(history(s), target(s), targets(s)))


@query
def orders_by_hour(s: WarehouseStage) -> DataFrame:
    return profiling.orders_by_hour(s.orders)


@query
def busiest_hours(s: WarehouseStage) -> DataFrame:
    return profiling.busiest_hours(s.orders)


@query
def gap_quantiles(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.gap_quantiles(s.orders))


@query
def product_popularity(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.product_popularity(history(s)))


@query
def product_popularity_quantiles(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.product_popularity_quantiles(history(s)))


@query
def department_summary(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.department_summary(history(s)))


@query
def aisle_summary(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.aisle_summary(history(s)))


@query
def top_aisles_by_count(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.top_aisles_by_count(history(s)))


@query
def top_aisles_by_reorder(s: WarehouseStage) -> DataFrame:
    return rounded(profiling.top_aisles_by_reorder(history(s)))


# --- baskets -----------------------------------------------------------------------------------


def _weighted(s: WarehouseStage) -> DataFrame:
    return baskets.weighted_baskets(baskets.baskets(purchases(s)))


def _filtered_rules(s: WarehouseStage) -> DataFrame:
    return baskets.filter_rules(baskets.association_rules(_weighted(s)), **RULE_THRESHOLDS)


@query
def aisle_baskets(s: WarehouseStage) -> DataFrame:
    return baskets.baskets(purchases(s)).select(
        "order_id", F.array_join("basket", "|").alias("basket")
    )


@query
def item_counts(s: WarehouseStage) -> DataFrame:
    return baskets.item_counts(_weighted(s))


@query
def item_pair_counts(s: WarehouseStage) -> DataFrame:
    return baskets.item_pair_counts(_weighted(s))


@query
def association_rules(s: WarehouseStage) -> DataFrame:
    return rounded(baskets.association_rules(_weighted(s)))


@query
def filtered_rules(s: WarehouseStage) -> DataFrame:
    return rounded(_filtered_rules(s))


@query
def bundle_pairs(s: WarehouseStage) -> DataFrame:
    return rounded(baskets.bundle_pairs(_filtered_rules(s)))


@query
def bundle_pair_count(s: WarehouseStage) -> DataFrame:
    return baskets.count_bundle_pairs(_filtered_rules(s))


@query
def top_bundles(s: WarehouseStage) -> DataFrame:
    return rounded(baskets.top_bundles(baskets.bundle_pairs(_filtered_rules(s))))


@query
def bundle_edges(s: WarehouseStage) -> DataFrame:
    return rounded(baskets.bundle_edges(baskets.bundle_pairs(_filtered_rules(s))))


@query
def bundle_nodes(s: WarehouseStage) -> DataFrame:
    return baskets.bundle_nodes(baskets.bundle_edges(baskets.bundle_pairs(_filtered_rules(s))))


# --- segments ----------------------------------------------------------------------------------


def _segment_features(s: WarehouseStage) -> DataFrame:
    return s.table("segment_features", lambda: seg.segment_features(history(s), s.orders))


def _segments(s: WarehouseStage) -> DataFrame:
    return s.table(
        "segments", lambda: seg.user_segments(_segment_features(s))
    )


def _fixed_segments(s: WarehouseStage) -> DataFrame:
    return _segment_features(s).withColumn("segment", (F.col("user_id") % 4).cast("int"))


@query
def segment_features(s: WarehouseStage) -> DataFrame:
    return rounded(seg.segment_features(history(s), s.orders))


@query
def segment_features_scaled(s: WarehouseStage) -> DataFrame:
    return rounded(seg.scaled_segment_features(_segment_features(s)))


@query
def segments_elbow(s: WarehouseStage) -> DataFrame:
    scaled = seg.scaled_segment_features(_segment_features(s))
    return seg.elbow_table(scaled)


@query
def user_segments(s: WarehouseStage) -> DataFrame:
    return seg.user_segments(_segment_features(s))


@query
def segment_profile(s: WarehouseStage) -> DataFrame:
    return seg.segment_profile(_segments(s))


@query
def cross_sell(s: WarehouseStage) -> DataFrame:
    return seg.cross_sell(history(s), _segments(s))


@query
def segment_profile_by_group(s: WarehouseStage) -> DataFrame:
    return rounded(seg.segment_profile(_fixed_segments(s)))


@query
def segment_aisles_by_group(s: WarehouseStage) -> DataFrame:
    return rounded(seg.segment_aisles(history(s), _fixed_segments(s)))


@query
def cross_sell_by_group(s: WarehouseStage) -> DataFrame:
    return rounded(seg.cross_sell(history(s), _fixed_segments(s)))


# --- evaluation --------------------------------------------------------------------------------


@query
def topk_baseline_eval(s: WarehouseStage) -> DataFrame:
    pairs = profiling.pair_counts(buy.with_order_attributes(s.prior, s.orders))
    return rounded(evaluation.evaluate_baseline(pairs, truth(s), scored_orders(s)))


@query
def order_prf(s: WarehouseStage) -> DataFrame:
    return rounded(
        evaluation.baseline_order_scores(candidates(s), truth(s), scored_orders(s))
    )


@query
def frequent_products(s: WarehouseStage) -> DataFrame:
    return evaluation.frequent_products(candidates(s))


@query
def score_alignment(s: WarehouseStage) -> DataFrame:
    return rounded(evaluation.align_scores(frequency_scores(s), s.orders))


@query
def auc(s: WarehouseStage) -> DataFrame:
    return rounded(evaluation.auc(simple_scores(s)))


@query
def average_precision(s: WarehouseStage) -> DataFrame:
    return rounded(evaluation.average_precision(simple_scores(s)))


@query
def logloss(s: WarehouseStage) -> DataFrame:
    return rounded(evaluation.log_loss(simple_scores(s)))


@query
def brier(s: WarehouseStage) -> DataFrame:
    return rounded(evaluation.brier(simple_scores(s)))


@query
def ece(s: WarehouseStage) -> DataFrame:
    return rounded(evaluation.calibration_error(simple_scores(s)))


@query
def row_metrics(s: WarehouseStage) -> DataFrame:
    return rounded(evaluation.row_metrics(simple_scores(s)))


@query
def threshold_eval(s: WarehouseStage) -> DataFrame:
    aligned = evaluation.align_scores(frequency_scores(s), s.orders)
    return rounded(
        evaluation.evaluate_thresholds(aligned, truth(s), scored_orders(s), THRESHOLDS)
    )


@query
def top_k_predictions(s: WarehouseStage) -> DataFrame:
    aligned = evaluation.align_scores(frequency_scores(s), s.orders)
    return rounded(evaluation.ranked_candidates(aligned, evaluation.TOP_K))


@query
def topk_eval(s: WarehouseStage) -> DataFrame:
    aligned = evaluation.align_scores(simple_scores(s), s.orders)
    return rounded(
        evaluation.evaluate_top_k(aligned, truth(s), scored_orders(s), models=SCORE_MODELS)
    )


@query
def recall_hit_at_k(s: WarehouseStage) -> DataFrame:
    aligned = evaluation.align_scores(frequency_scores(s), s.orders)
    return rounded(evaluation.recall_hit_at_k(aligned, truth(s), scored_orders(s)))


@query
def model_preference(s: WarehouseStage) -> DataFrame:
    return evaluation.preferred_model(simple_scores(s), SCORE_PREFERENCE)


@query
def method_summary(s: WarehouseStage) -> DataFrame:
    aligned = evaluation.align_scores(simple_scores(s), s.orders)
    by_model = evaluation.evaluate_top_k(
        aligned, truth(s), scored_orders(s), models=SCORE_MODELS
    )
    baseline = evaluation.evaluate_baseline(candidates(s), truth(s), scored_orders(s))
    return rounded(evaluation.method_summary(by_model, baseline))


@query
def blend_scores(s: WarehouseStage) -> DataFrame:
    scores = simple_scores(s)
    return rounded(
        evaluation.blend_scores(
            scores.where("model = 'frequency'"), scores.where("model = 'recency'")
        )
    )


# --- learning ----------------------------------------------------------------------------------


def _trees(s: WarehouseStage, name: str) -> models.FittedTrees:
    return next_order.fitted_trees(s.tables(), s, name)


def _scores(s: WarehouseStage, name: str) -> DataFrame:
    return next_order.staged_scores(s.tables(), s, name)


@query
def scaled_features(s: WarehouseStage) -> DataFrame:
    train, held_out = features.split_by_user(candidates(s))
    kept = ["user_id", "product_id", *features.TABLE_FEATURES]
    return rounded(
        seg.standardize(held_out.select(*kept), features.TABLE_FEATURES, fit_on=train)
    )


@query
def als_affinity(s: WarehouseStage) -> DataFrame:
    return affinity.affinity_features(candidates(s), reindex=True)


@query
def vector_similarity(s: WarehouseStage) -> DataFrame:
    vectors = s.spark.read.parquet(f"{s.folder}/embeddings.parquet")
    return rounded(affinity.similarity_to_groups(vectors))


@query
def logreg_scores(s: WarehouseStage) -> DataFrame:
    return _scores(s, "logistic")


@query
def gbt_scores_a(s: WarehouseStage) -> DataFrame:
    return _scores(s, "boosted_a")


@query
def gbt_scores_b(s: WarehouseStage) -> DataFrame:
    return _scores(s, "boosted_b")


@query
def gbt_scores_c(s: WarehouseStage) -> DataFrame:
    return _scores(s, "boosted_c")


@query
def mlp_scores(s: WarehouseStage) -> DataFrame:
    return _scores(s, "perceptron")


@query
def feature_importance(s: WarehouseStage) -> DataFrame:
    return _trees(s, "boosted_a").importance()


@query
def training_curve(s: WarehouseStage) -> DataFrame:
    return _trees(s, "boosted_a").training_curve()


@query
def training_curve_b(s: WarehouseStage) -> DataFrame:
    return _trees(s, "boosted_b").training_curve()


def _fitted(s: WarehouseStage) -> dict[str, DataFrame]:
    return next_order.predict_next_orders(s.tables(), s, with_blend=True)


@query
def model_row_metrics(s: WarehouseStage) -> DataFrame:
    return _fitted(s)["row_metrics"]


@query
def model_recall_hit(s: WarehouseStage) -> DataFrame:
    return _fitted(s)["recall_hit_at_k"]


@query
def model_summary(s: WarehouseStage) -> DataFrame:
    return _fitted(s)["summary"]
