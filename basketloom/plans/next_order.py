"""Next-order prediction, end to end: features, affinity, models, evaluation against a baseline."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from ..operators import affinity, evaluation, features, models
from ..operators.cleaning import union_all
from ..schemas import Tables
from ..sources import Stage
from ..sources.staging import fingerprint

# The models fitted by default; the third boosted preset is optional.
DEFAULT_MODELS = ("logistic", "boosted_a", "boosted_b", "perceptron")


def staged_pairs(tables: Tables, stage: Stage) -> DataFrame:
    """Totals per (user, product), written once."""
    return stage.table(
        f"pair_totals-{fingerprint(tables)}",
        lambda: features.pair_totals(features.prior_details(tables)),
    )


def staged_affinity(tables: Tables, stage: Stage) -> DataFrame:
    """Affinity features of every pair, written once."""
    counts = staged_pairs(tables, stage).withColumnRenamed("lines", "up_buy_cnt")
    return stage.table(
        f"affinity-{fingerprint(tables)}",
        lambda: affinity.affinity_features(counts, reindex=True),
    )


def staged_candidates(tables: Tables, stage: Stage, with_affinity: bool = True) -> DataFrame:
    """The candidate table, with or without the affinity features, written once."""

    def build() -> DataFrame:
        factors = staged_affinity(tables, stage) if with_affinity else None
        pairs = staged_pairs(tables, stage)
        products = stage.table(
            f"product_table-{fingerprint(tables)}",
            lambda: features.product_table(pairs, tables.products),
        )
        return features.candidate_table(tables, factors, pairs=pairs, products=products)

    kind = "full_candidates" if with_affinity else "candidates"
    return stage.table(f"{kind}-{fingerprint(tables)}", build)


def fitted_trees(
    tables: Tables, stage: Stage, name: str, rounds: int | None = None, with_affinity: bool = True
) -> models.FittedTrees:
    """A boosted model of the candidates, fitted once."""

    def fit() -> models.FittedTrees:
        parts = features.split_by_user(staged_candidates(tables, stage, with_affinity))
        inputs = features.FEATURES if with_affinity else features.TABLE_FEATURES
        return models.fit_trees(*parts, models.PRESETS[name], inputs, rounds=rounds)

    return stage.once(f"{name}-{rounds}-{with_affinity}-{fingerprint(tables)}", fit)


def staged_scores(
    tables: Tables, stage: Stage, name: str, rounds: int | None = None, with_affinity: bool = True
) -> DataFrame:
    """Scores of one named model, (model, user_id, product_id, label, prob), written once."""

    def build() -> DataFrame:
        if name in models.PRESETS:
            return fitted_trees(tables, stage, name, rounds, with_affinity).scores(name)
        parts = features.split_by_user(staged_candidates(tables, stage, with_affinity))
        inputs = features.FEATURES if with_affinity else features.TABLE_FEATURES
        if name == "logistic":
            return models.logistic_scores(*parts, inputs)
        return models.perceptron_scores(*parts, inputs)

    own = rounds if name in models.PRESETS else None
    return stage.table(f"scores_{name}-{own}-{with_affinity}-{fingerprint(tables)}", build)


def fitted_together(
    tables: Tables, stage: Stage, names: Sequence[str], rounds: int | None, with_affinity: bool
) -> dict[str, DataFrame]:
    """``staged_scores`` of several models, fitted side by side.

    No fit needs another, and each is a row of short jobs or of a few tasks that leave cores idle. The
    candidates that all of them read have to be staged before.
    """

    def scores(name: str) -> DataFrame:
        return staged_scores(tables, stage, name, rounds, with_affinity)

    staged_candidates(tables, stage, with_affinity)
    # Jobs of a thread belong to the caller's group, where threads of Python have threads of the JVM.
    wrap = inheritable_thread_target(stage.spark)
    run = wrap(scores) if callable(wrap) else scores
    with ThreadPoolExecutor(max(1, len(names))) as pool:
        started = {name: pool.submit(run, name) for name in names}
        return {name: found.result() for name, found in started.items()}


def predict_next_orders(
    tables: Tables,
    stage: Stage,
    names: Sequence[str] = DEFAULT_MODELS,
    k: int = evaluation.TOP_K,
    rounds: int | None = None,
    with_affinity: bool = True,
    with_blend: bool = False,
) -> dict[str, DataFrame]:
    """Every result of the prediction path as a named DataFrame.

    The pair totals, the candidates and the scores are written to the stage once: each is read by
    several branches below. ``with_blend`` adds 0.2 logistic + 0.8 of the preferred boosted model.
    """
    counts = staged_pairs(tables, stage).withColumnRenamed("lines", "up_buy_cnt")
    candidates = staged_candidates(tables, stage, with_affinity)
    by_model = fitted_together(tables, stage, names, rounds, with_affinity)
    chosen = next((m for m in evaluation.MODEL_PREFERENCE if m in by_model), names[0])
    if with_blend:
        mixed = evaluation.blend_scores(by_model["logistic"], by_model[chosen])
        by_model["blend"] = mixed.selectExpr("'blend' AS model", "*")
    scores = union_all(by_model.values())
    orders = evaluation.validation_orders(tables.orders)
    truth = evaluation.true_products(tables.train)
    aligned = evaluation.align_scores(scores, tables.orders)
    top = evaluation.evaluate_top_k(aligned, truth, orders, k, list(by_model))
    baseline = evaluation.evaluate_baseline(counts, truth, orders, k)
    best = aligned.where(aligned.model == chosen).drop("model")
    return {
        "candidates": candidates,
        "positive_rate": features.positive_rate(candidates),
        "scores": scores,
        "row_metrics": evaluation.row_metrics(scores),
        "top_k": top,
        "recall_hit_at_k": evaluation.recall_hit_at_k(best, truth, orders),
        "baseline": baseline,
        "summary": evaluation.method_summary(top, baseline),
    }
