"""Gradient histograms and split search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUND_DIGITS = 9


def _shrunk(g: str, alpha: float) -> str:
    """L1 shrinkage of a gradient sum."""
    return g if alpha == 0 else f"(signum({g}) * greatest(abs({g}) - {alpha}D, 0D))"


def _score(g: str, h: str, reg_lambda: float, alpha: float) -> str:
    return f"coalesce(try_divide(pow({_shrunk(g, alpha)}, 2), {h} + {reg_lambda}D), 0D)"


def leaf_weight(g: str, h: str, reg_lambda: float = 1.0, alpha: float = 0.0, eta: float = 1.0) -> Column:
    """Weight of a leaf from the names of its gradient and hessian sums."""
    return F.expr(f"try_divide(-{_shrunk(g, alpha)}, {h} + {reg_lambda}D) * {eta}D")


def node_totals(spark: SparkSession, rows: list[tuple[int, int, float, float]]) -> DataFrame:
    """``(class_id, node, g_all, h_all)`` of the open nodes, as an inline table."""
    values = ", ".join(f"({c}, {n}, {g!r}D, {h!r}D)" for c, n, g, h in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(class_id, node, g_all, h_all)")


def split_candidates(histogram: DataFrame, totals: DataFrame, reg_lambda: float = 1.0, alpha: float = 0.0,
                     gamma: float = 0.0, min_child_weight: float = 0.0) -> DataFrame:
    """Every split "bin < b" with both default directions and its gain.

    ``histogram`` is ``(class_id, node, feature, bin, g, h)`` with one row per cell; ``totals`` has
    one row per open node and is therefore small. What a feature's bins lack of the node total are
    the rows where it is missing.
    """
    cell = "PARTITION BY class_id, node, feature"
    below = f"({cell} ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    sums = histogram.selectExpr(
        "class_id", "node", "feature", "bin",
        f"coalesce(sum(g) OVER {below}, 0D) AS gl", f"coalesce(sum(h) OVER {below}, 0D) AS hl",
        f"sum(g) OVER ({cell}) AS g_in", f"sum(h) OVER ({cell}) AS h_in",
    ).join(F.broadcast(totals), ["class_id", "node"])
    both = sums.selectExpr(
        "class_id", "node", "feature", "bin", "g_all", "h_all",
        "stack(2, true, gl + g_all - g_in, hl + h_all - h_in, false, gl, hl) AS (default_left, g_left, h_left)",
    )
    gain = (f"{_score('g_left', 'h_left', reg_lambda, alpha)} "
            f"+ {_score('(g_all - g_left)', '(h_all - h_left)', reg_lambda, alpha)} "
            f"- {_score('g_all', 'h_all', reg_lambda, alpha)} - {gamma}D")
    return both.where(f"h_left >= {min_child_weight}D AND h_all - h_left >= {min_child_weight}D").selectExpr(
        "class_id", "node", "feature", "bin", "default_left", "g_left", "h_left", "g_all", "h_all",
        f"round({gain}, {ROUND_DIGITS}) AS gain",
    )


def best_splits(candidates: DataFrame) -> DataFrame:
    """The split of highest gain per node; ties go to the lowest feature, then the lowest bin."""
    return candidates.groupBy("class_id", "node").agg(F.expr(
        "max_by(struct(feature, bin, default_left, gain, g_left, h_left), "
        "struct(gain, -feature, -bin, default_left))").alias("s")).select("class_id", "node", "s.*")
