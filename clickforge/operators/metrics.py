"""Evaluation metrics. Scores and labels are column names; ``by`` groups the result (e.g. by split)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge.functions import positive_score

# Probabilities are clipped to [EPS, 1 - EPS] inside logarithms.
EPS = 1e-15
# Positive means a label above this value.
POSITIVE = 0.1
# Blocks of scores for each power of two, and more than any power of a double.
BLOCKS, POWERS = 4096, 1100


class ScoreHistogram:
    """AUC from a histogram of probabilities, without a sort: the value and how far it can be from the exact one.

    A class of scores keeps its least and greatest score; a class with one score only is exact (ties count one half). In the others
    the order of a positive and a negative is unknown, so a pair counts one half and half of them bound the error.
    """

    def __init__(self, classes: int = 16384):
        if classes < 1:
            raise ValueError("classes must be at least 1")
        self.classes = classes

    def evaluate(self, df: DataFrame, label: Column, score: Column, by: str) -> dict[str, tuple[float | None, float | None]]:
        """(AUC, bound) of each group; null where a class of labels is absent. Rows without a score or label count for nothing."""
        return {group: found for (group, _), found in self.evaluate_many(df, label, [score], F.col(by)).items()}

    def evaluate_many(self, df: DataFrame, label: Column, scores: Sequence[Column], by: Column) -> dict[tuple[str, int], tuple[float | None, float | None]]:
        """(AUC, bound) of each group and score, from one aggregation."""
        each = df.select(by.alias("by"), (label > POSITIVE).cast("bigint").alias("y"), F.posexplode(F.array(*scores)).alias("model", "s"))
        place = F.least(F.floor(F.col("s") * self.classes), F.lit(self.classes - 1)).cast("int")
        counted = each.where("y is not null and s is not null and not isnan(s)").groupBy("by", "model", place.alias("place")).agg(
            F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"), F.min("s").alias("low"), F.max("s").alias("high"))
        groups: dict[tuple[str, int], list] = {}
        for r in counted.collect():  # at most one row for each group, score and class
            groups.setdefault((r["by"], r["model"]), []).append(r)
        return {key: self._area(sorted(rows, key=lambda r: r.place)) for key, rows in groups.items()}

    @staticmethod
    def _area(rows: list) -> tuple[float | None, float | None]:
        below = ordered = unsure = 0
        for r in rows:
            ordered += r.pos * below + r.pos * r.neg / 2
            unsure += 0 if r.low == r.high else r.pos * r.neg / 2
            below += r.neg
        pairs = sum(r.pos for r in rows) * below
        return (ordered / pairs, unsure / pairs) if pairs else (None, None)


def label_distribution(df: DataFrame, by: Sequence[str] = ("split",), label: str = "label") -> DataFrame:
    """Rows per label and split, in one job for all splits."""
    return df.groupBy(*by, label).agg(F.count("*").alias("n"))


def row_log_loss(label: Column, score: Column, eps: float = EPS) -> Column:
    p = F.when(F.isnan(score), score).when(score < eps, eps).when(score > 1 - eps, 1 - eps).otherwise(score)
    return -(label * F.ln(p) + (1 - label) * F.ln(1 - p))


def log_loss(label: Column, score: Column) -> Column:
    """Mean logistic loss; an aggregate usable on its own or as a training metric."""
    return F.avg(row_log_loss(label, score))


def normalized_entropy(label: Column, score: Column) -> Column:
    """Log loss over the entropy of the base rate; null when only one class is present."""
    rate = F.avg(label)
    inside = F.when((rate > 0) & (rate < 1), rate)
    return log_loss(label, score) / -(inside * F.ln(inside) + (1 - inside) * F.ln(1 - inside))


def calibration(label: Column, score: Column) -> Column:
    """Predicted over observed positives; null without positives."""
    return F.try_divide(F.sum(score), F.sum(label))


def error_at_half(label: Column, score: Column) -> Column:
    """Share of rows on the wrong side of one half."""
    return F.avg(((label == 0) & (score > 0.5) | (label == 1) & (score <= 0.5)).cast("double"))


def margin_error(label: Column, margin: Column) -> Column:
    """Share of rows with the margin on the wrong side of zero."""
    return F.avg(((label == 0) & (margin > 0) | (label == 1) & (margin <= 0)).cast("double"))


def accuracy(label: Column, prediction: Column) -> Column:
    return F.avg((label == prediction).cast("double"))


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(F.pow(label - prediction, 2)))


def metric(df: DataFrame, by: Sequence[str] = (), **metrics: Column) -> DataFrame:
    """Several aggregates in one pass."""
    return df.groupBy(*by).agg(*[m.alias(name) for name, m in metrics.items()])


def _scored(score: Column) -> Column:
    return score.isNotNull() & ~F.isnan(score)


def _block(score: Column) -> Column:
    """A whole number that never falls as the score rises: equal shares of each power of two, so scores of any size spread."""
    size = F.least(F.floor(F.least(F.log2(F.abs(score)), F.lit(float(POWERS))) * BLOCKS), F.lit(POWERS * BLOCKS)) + POWERS * BLOCKS
    return F.when(score > 0, size + 1).when(score < 0, -size - 1).otherwise(0).cast("bigint")


def _tied_counts(df: DataFrame, label: str, score: str, by: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    p = positive_score(df, score)
    positive = F.when(_scored(p), (F.col(label) > POSITIVE).cast("bigint"))
    return df.groupBy(*by, F.when(_scored(p), p.cast("double")).alias("__q")).agg(
        F.coalesce(F.sum(positive), F.lit(0)).alias("__pos"), F.coalesce(F.sum(1 - positive), F.lit(0)).alias("__neg"),
        *[c.alias(n) for n, c in sums.items()],
    )


def _rank_sums(df: DataFrame, label: str, score: str, by: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Per group: positives, negatives, correctly ordered pairs (ties one half) and ``sums``.

    Rows collapse to one per distinct score before anything is ordered; scores are compared as the doubles they are. The
    running count of negatives is then built in two levels: inside blocks of scores, ``BLOCKS`` for each power of two, and over
    the blocks, so a group with most of the rows does not sort in one task. Rows without a score, or with NaN,
    are in ``sums`` but in no pair.
    """
    by = list(by)
    ties = _tied_counts(df, label, score, by, sums).withColumn("__block", _block(F.col("__q")))
    inside = Window.partitionBy(*by, "__block").orderBy("__q").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__neg").over(inside), F.lit(0))
    blocks = (
        ties.withColumn("__pairs", F.col("__pos") * (before + F.col("__neg") / 2))
        .groupBy(*by, "__block")
        .agg(*[F.sum(c).alias(c) for c in ("__pos", "__neg", "__pairs", *sums)])
    )
    over = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("__neg").over(over), F.lit(0))
    return (
        blocks.withColumn("__pairs", F.col("__pairs") + F.col("__pos") * below)
        .groupBy(*by)
        .agg(*[F.sum(c).alias(c) for c in ("__pos", "__neg", "__pairs", *sums)])
    )


def auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (), unscored: bool = False) -> DataFrame:
    """Area under the ROC curve by rank sums, ties averaged; null when a class is absent.

    Rows with a null or NaN score are left out; with ``unscored``, a column ``n_unscored`` counts them.
    """
    counted = {"n_unscored": F.sum((~_scored(positive_score(df, score))).cast("bigint"))} if unscored else {}
    sums = _rank_sums(df, label, score, by, counted)
    return sums.select(*by, F.try_divide("__pairs", F.col("__pos") * F.col("__neg").cast("double")).alias("auc"), *counted)


def auc_of_prediction(df: DataFrame, label: str = "label", prediction: str = "prediction",
                      by: Sequence[str] = ()) -> DataFrame:
    """AUC of the hard 0/1 prediction, that is (TPR + TNR) / 2."""
    return auc(df, label, prediction, by)


def evaluate_splits(df: DataFrame, label: str = "label", score: str = "score",
                    by: Sequence[str] = ("split",), eps: float = EPS) -> DataFrame:
    """One row per split: n, positives, auc, ne, calibration, logloss, n_clipped. One scan."""
    p, y = positive_score(df, score), F.col(label).cast("double")
    sums = _rank_sums(df, label, score, by, {
        "__n": F.count("*"), "__y": F.sum(y), "__p": F.sum(p), "__positives": F.sum((y > POSITIVE).cast("bigint")),
        "__loss": F.sum(row_log_loss(y, p, eps)),
        "n_clipped": F.sum(((p < eps) | (p > 1 - eps)).cast("bigint")),
    })
    rate = F.col("__y") / F.col("__n")
    inside = F.when((rate > 0) & (rate < 1), rate)
    loss = F.col("__loss") / F.col("__n")
    return sums.select(
        *by,
        F.col("__n").alias("n"),
        F.col("__positives").alias("positives"),
        F.try_divide("__pairs", F.col("__pos") * F.col("__neg").cast("double")).alias("auc"),
        (loss / -(inside * F.ln(inside) + (1 - inside) * F.ln(1 - inside))).alias("ne"),
        F.try_divide("__p", "__y").alias("calibration"),
        loss.alias("logloss"),
        "n_clipped",
    )


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)``."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def per_label_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, n, tpr, fpr, precision, recall, f)`` with each label in turn as the positive class.

    Labels that occur in the data get a row. A rate without a denominator is 0.
    """
    cells = confusion(df, label, prediction)
    side = cells.select(F.explode(F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("called"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("called"),
                 F.lit(0).cast("bigint").alias("hit")),
    )).alias("s")).select("s.*")
    per = side.groupBy("c").agg(F.sum("actual").alias("actual"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
    # One row per label: the total is a window over that small table.
    per = per.withColumn("total", F.sum("actual").over(Window.partitionBy(F.lit(1))))

    def rate(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    tpr = rate(F.col("hit"), F.col("actual"))
    fpr = rate(F.col("called") - F.col("hit"), F.col("total") - F.col("actual"))
    precision = rate(F.col("hit"), F.col("called"))
    f = rate(2 * precision * tpr, precision + tpr)
    return per.filter(F.col("actual") > 0).select(
        F.col("c").alias("label"), F.col("actual").alias("n"), tpr.alias("tpr"), fpr.alias("fpr"),
        precision.alias("precision"), tpr.alias("recall"), f.alias("f"),
    )


def weighted_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The per-label rates weighted by class share, and the accuracy."""
    rates = per_label_rates(df, label, prediction)
    weighted = [(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in ("tpr", "fpr", "precision", "recall", "f")]
    return rates.agg(*weighted, (F.sum(F.col("recall") * F.col("n")) / F.sum("n")).alias("accuracy"))


def same_predictions(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side than on the other; empty when both agree."""
    names = left.columns
    return left.exceptAll(right.select(*names)).unionByName(right.select(*names).exceptAll(left))


