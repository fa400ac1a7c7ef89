"""Tree ensembles: the model table, scoring, leaf encodings, importance and node means."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from clickforge.functions import predicted_class, sigmoid
from clickforge.operators.sparse import element_rows, feats_column, list_owner
from clickforge.operators.walk import FlatTree, dense_columns, used_features, walk_tree

MODEL_SCHEMA = (
    "tree int, class_id int, node int, parent int, depth int, is_leaf boolean, feature int, "
    "threshold double, left int, right int, default_left boolean, leaf_value double, "
    "gain double, sum_hess double"
)
MODEL_COLUMNS = [part.strip().split()[0] for part in MODEL_SCHEMA.split(",")]

# Ensembles up to this many splits become CASE expressions. A deeper nest leaves whole-stage
# codegen, and then the Arrow walk is faster.
CASE_SPLIT_LIMIT = 24
# Cells of the dense scoring matrix held by a task at one time.
MATRIX_CELLS = 4_000_000


class TreeEnsemble:
    """A boosted model: node rows as described by ``MODEL_SCHEMA``, ids from 0.

    The driver holds ``trees x nodes per tree`` rows, a size set by the training options and
    not by the data. ``num_class`` is 1 for a binary model, else one tree per class and round.
    Values equal to ``missing`` count as absent, as they did in training.
    """

    def __init__(self, nodes: Iterable[dict], num_class: int = 1, missing: float | None = None):
        self.nodes = [{c: n.get(c) for c in MODEL_COLUMNS} for n in nodes]
        self.num_class = num_class
        self.missing = missing
        by_tree: dict[int, list[dict]] = {}
        for n in self.nodes:
            by_tree.setdefault(n["tree"], []).append(n)
        self.by_tree = [by_tree[t] for t in sorted(by_tree)]

    @classmethod
    def from_splits(cls, trees: list[dict[int, tuple]], index_base: int = 0) -> TreeEnsemble:
        """Build from ``{node: (feature, threshold, left, right, missing) or leaf value}`` dicts.

        ``missing`` is the child that takes rows without the feature.
        """
        nodes = []
        for t, tree in enumerate(trees):
            pending = [(0, -1, 0)]
            while pending:
                node, parent, depth = pending.pop(0)
                row = {"tree": t, "class_id": 0, "node": node, "parent": parent, "depth": depth}
                body = tree[node]
                if isinstance(body, tuple):
                    feature, threshold, left, right, missing = body
                    row |= {"is_leaf": False, "feature": feature - index_base, "threshold": threshold,
                            "left": left, "right": right, "default_left": missing == left}
                    pending += [(left, node, depth + 1), (right, node, depth + 1)]
                else:
                    row |= {"is_leaf": True, "leaf_value": float(body)}
                nodes.append(row)
        return cls(nodes)

    @property
    def num_trees(self) -> int:
        return len(self.by_tree)

    @property
    def num_splits(self) -> int:
        return sum(not n["is_leaf"] for n in self.nodes)

    def first(self, rounds: int) -> TreeEnsemble:
        """The first ``rounds`` boosting rounds; 0 or too many means all."""
        keep = rounds * self.num_class
        if rounds <= 0 or keep >= self.num_trees:
            return self
        return TreeEnsemble((n for n in self.nodes if n["tree"] < keep), self.num_class, self.missing)

    def flat(self) -> list[FlatTree]:
        return [FlatTree.from_nodes(tree) for tree in self.by_tree]

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(n[c] for c in MODEL_COLUMNS) for n in self.nodes], MODEL_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model table as parquet."""
        table = self.to_df(spark).withColumns({"num_class": F.lit(self.num_class), "missing": F.lit(self.missing).cast("double")})
        table.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeEnsemble:
        rows = spark.read.parquet(path).orderBy("tree", "node").collect()
        first = rows[0].asDict() if rows else {}
        return cls((r.asDict() for r in rows), first.get("num_class", 1), first.get("missing"))


# ---------------------------------------------------------------- scoring

def _case_tree(tree: list[dict], names: dict[int, str], out: str) -> Column:
    """The tree as one nested CASE that returns the leaf's ``out`` entry.

    A comparison with a missing value is null, which takes the ELSE branch; only a split with a
    left default has to ask for null.
    """
    nodes = {n["node"]: n for n in tree}

    def visit(node: dict) -> str:
        if node["is_leaf"]:
            return f"{node[out]!r}D" if out == "leaf_value" else str(node[out])
        x = f"`{names[node['feature']]}`"
        left = f"{x} < double('{float(node['threshold'])!r}')" + (f" OR {x} IS NULL" if node["default_left"] else "")
        return f"CASE WHEN {left} THEN {visit(nodes[node['left']])} ELSE {visit(nodes[node['right']])} END"

    return F.expr(visit(nodes[0]))


def _with_case_columns(df: DataFrame, model: TreeEnsemble, features) -> tuple[DataFrame, dict[int, str], list[str]]:
    """Project the features the model splits on once, so that every CASE reads a plain column.

    Of an id that a sparse row repeats, the last value counts, as in the Arrow walk.
    """
    names = {int(f): f"__f{f}" for f in used_features(model.flat())}
    if not isinstance(features, str):
        columns = [F.col(c) if isinstance(c, str) else c for c in features]
        picked = {name: _absent_as_null(columns[f].cast("double"), model.missing) for f, name in names.items()}
        return df.withColumns(picked), names, list(names.values())
    df = df.withColumn("__entries", feats_column(df, features))

    def last(f: int) -> Column:
        return F.try_element_at(F.filter("__entries", lambda e: e["f"] == f), F.lit(-1))["v"]

    df = df.withColumns({name: _absent_as_null(last(f), model.missing) for f, name in names.items()})
    return df, names, [*names.values(), "__entries"]


def _absent_as_null(x: Column, missing: float | None) -> Column:
    x = F.nanvl(x, F.lit(None).cast("double"))
    return x if missing is None else F.nullif(x, F.lit(float(missing)))


def leaf_udf(trees: list[FlatTree], missing: float | None = None):
    """Arrow function from sparse rows to the leaf reached in every tree."""
    used = used_features(trees)
    column_of = np.zeros(int(used.max()) + 1 if len(used) else 1, np.int64)
    column_of[used] = np.arange(len(used))
    step = max(1, MATRIX_CELLS // max(1, len(used)))

    def walk_block(block: pa.ListArray) -> np.ndarray:
        entries = block.flatten()
        ids = entries.field("f").to_numpy(zero_copy_only=False).astype(np.int64)
        values = entries.field("v").to_numpy(zero_copy_only=False).astype(np.float64)
        if missing is not None:
            values = np.where(values == missing, np.nan, values)
        at = np.searchsorted(used, ids)
        column = np.where((at < len(used)) & (used[np.minimum(at, len(used) - 1)] == ids), at, -1) if len(used) else ids * 0 - 1
        matrix = dense_columns(list_owner(block), column, values, len(used), len(block))
        return np.stack([walk_tree(t, matrix, column_of) for t in trees], axis=1)

    @arrow_udf("array<int>")
    def leaves(rows: pa.Array) -> pa.Array:
        parts = [walk_block(rows.slice(i, step)) for i in range(0, len(rows), step)]
        found = np.concatenate(parts) if parts else np.zeros((0, len(trees)))
        offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(trees)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found.ravel().astype(np.int32)))

    return leaves


def _leaf_values(model: TreeEnsemble) -> Column:
    """Literal ``value[tree][node]`` table."""
    text = "[" + ",".join("[" + ",".join(repr(float(v)) for v in t.value) + "]" for t in model.flat()) + "]"
    return F.from_json(F.lit(text), "array<array<double>>")


def tree_leaf(df: DataFrame, model: TreeEnsemble, features, output: str = "leaves",
              rounds: int = 0, method: str = "auto") -> DataFrame:
    """Append the node id reached in every tree. A missing feature takes the default child."""
    model = model.first(rounds)
    if _use_case(model, method):
        work, names, extra = _with_case_columns(df, model, features)
        ids = [_case_tree(t, names, "node") for t in model.by_tree]
        return work.withColumn(output, F.array(*ids)).drop(*extra)
    return df.withColumn(output, leaf_udf(model.flat(), model.missing)(feats_column(df, features)))


def _use_case(model: TreeEnsemble, method: str) -> bool:
    if method not in ("auto", "case", "arrow"):
        raise ValueError(f"unknown method {method!r}")
    return method == "case" or (method == "auto" and model.num_splits <= CASE_SPLIT_LIMIT)


def tree_margin(df: DataFrame, model: TreeEnsemble, features, output: str = "margin",
                rounds: int = 0, method: str = "auto") -> DataFrame:
    """Append the summed leaf values: a double, or one per class for a multiclass model."""
    model = model.first(rounds)
    k = model.num_class
    if _use_case(model, method):
        work, names, extra = _with_case_columns(df, model, features)
        per_class = [F.lit(0.0)] * k
        for i, tree in enumerate(model.by_tree):
            per_class[i % k] = per_class[i % k] + _case_tree(tree, names, "leaf_value")
        margin = per_class[0] if k == 1 else F.array(*per_class)
        return work.withColumn(output, margin).drop(*extra)
    work = tree_leaf(df, model, features, "__leaves", method="arrow")
    return margin_from_leaves(work, model, "__leaves", output).drop("__leaves")


def margin_from_leaves(df: DataFrame, model: TreeEnsemble, leaves: str = "leaves", output: str = "margin") -> DataFrame:
    """Append the margin of rows whose leaves are known already."""
    k = model.num_class
    table = _leaf_values(model)
    values = F.transform(leaves, lambda leaf, t: F.get(F.get(table, t), leaf))

    def total(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)

    if k == 1:
        return df.withColumn(output, total(values))
    per_class = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)), lambda c: total(F.filter(values, lambda _, i: i % k == c)))
    return df.withColumn(output, per_class)


def softmax(margins: str | Column) -> Column:
    top = F.array_max(margins)
    exps = F.transform(margins, lambda m: F.exp(m - top))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, e: acc + e)
    return F.transform(exps, lambda e: e / total)


def tree_predict(df: DataFrame, model: TreeEnsemble, features, output_margin: bool = False,
                 rounds: int = 0, method: str = "auto") -> DataFrame:
    """Append ``margin``, ``probability`` and the 0/1 (or class) ``prediction``.

    Margins start at 0, which is right for a base score of one half.
    """
    scored = tree_margin(df, model, features, "margin", rounds, method)
    if output_margin:
        return scored
    if model.num_class == 1:
        scored = scored.withColumn("probability", sigmoid(F.col("margin")))
        return scored.withColumn("prediction", predicted_class(F.col("probability")))
    scored = scored.withColumn("probability", softmax("margin"))
    best = F.array_position("probability", F.array_max("probability")) - 1
    return scored.withColumn("prediction", best.cast("double"))


# ---------------------------------------------------------------- leaf encodings

def leaf_long(df: DataFrame, leaves: str, keys: list[str]) -> DataFrame:
    """Long form ``(keys, tree, leaf)`` of a leaf array."""
    return element_rows(df, leaves, ("tree", "leaf"), keys)


def string_leaf_vocabulary(df: DataFrame, leaves: str = "leaves") -> DataFrame:
    """``(tree, leaf, n, index, position)``: leaves of each tree by falling frequency.

    Ties go by the leaf id as text. ``position`` is ``index`` plus the sizes of earlier trees.
    The table has at most trees x leaves rows; all trees are counted in one job.
    """
    counts = leaf_long(df, leaves, []).groupBy("tree", "leaf").agg(F.count("*").alias("n"))
    order = Window.partitionBy("tree").orderBy(F.desc("n"), F.col("leaf").cast("string"))
    indexed = counts.withColumn("index", F.row_number().over(order) - 1)
    return _with_position(indexed)


def _with_position(entries: DataFrame) -> DataFrame:
    """Add ``position``: the index plus the sizes of the trees before, that is the rank over all trees.

    The table has one row per leaf of the model, so one ordered window is enough, and the rows
    behind it are read once.
    """
    rank = F.row_number().over(Window.orderBy("tree", "index"))
    return entries.withColumn("position", rank - 1)


def node_leaf_vocabulary(df: DataFrame, leaves: str = "leaves") -> DataFrame:
    """``(tree, size, offset)`` for the encoding in which the node id itself is the category."""
    sizes = leaf_long(df, leaves, []).groupBy("tree").agg((F.max("leaf") + 1).alias("size"))
    before = Window.orderBy("tree").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("int"))


def ordinal_leaf_vocabulary(spark: SparkSession, model: TreeEnsemble) -> DataFrame:
    """``(tree, leaf, index, position)``: leaves of each tree numbered by node id.

    It depends on the model alone, so it needs no pass over the rows. A root-only tree has one
    leaf with index 0.
    """
    leaves = model.to_df(spark).filter("is_leaf").select("tree", F.col("node").alias("leaf"))
    indexed = leaves.withColumn("index", F.row_number().over(Window.partitionBy("tree").orderBy("leaf")) - 1)
    return _with_position(indexed)


def _lookup_column(entries: list[tuple[int, int, int]], trees: int) -> Column:
    """Literal ``position[tree][leaf]`` table from (tree, leaf, position) entries."""
    table: list[list] = [[] for _ in range(trees)]
    for tree, leaf, position in entries:
        row = table[tree]
        row.extend(["null"] * (leaf + 1 - len(row)))
        row[leaf] = str(position)
    text = "[" + ",".join("[" + ",".join(r) + "]" for r in table) + "]"
    return F.from_json(F.lit(text), "array<array<int>>")


def encode_leaves(df: DataFrame, vocabulary: DataFrame, leaves: str = "leaves",
                  output: str = "onehot") -> DataFrame:
    """Append the hot positions of each row, one per tree; a leaf outside the vocabulary gives none.

    The vocabulary is bounded by the model, so it travels as a literal and rows are neither
    shuffled nor exploded.
    """
    entries = [(r["tree"], r["leaf"], r["position"]) for r in vocabulary.select("tree", "leaf", "position").collect()]
    table = _lookup_column(entries, max((e[0] for e in entries), default=-1) + 1)
    hot = F.transform(leaves, lambda leaf, tree: F.get(F.get(table, tree), leaf))
    return df.withColumn(output, F.filter(hot, lambda p: p.isNotNull()))


def encode_leaves_by_node(df: DataFrame, vocabulary: DataFrame, leaves: str = "leaves",
                          output: str = "onehot") -> DataFrame:
    """Hot positions ``offset(tree) + node id``; ids at or above a tree's size give none."""
    rows = vocabulary.orderBy("tree").collect()
    offsets = F.array(*[F.lit(r["offset"]) for r in rows])
    sizes = F.array(*[F.lit(r["size"]) for r in rows])
    hot = F.transform(leaves, lambda leaf, t: F.when(leaf < F.get(sizes, t), leaf + F.get(offsets, t)))
    return df.withColumn(output, F.filter(hot, lambda p: p.isNotNull()))


def leaf_vector(df: DataFrame, vocabulary: DataFrame, leaves: str = "leaves",
                output: str = "leaf_features") -> DataFrame:
    """Append the one-hot leaves as a sparse vector, ready for a linear model."""
    entries = vocabulary.select("tree", "leaf").orderBy("position").collect()
    words = [f"{r['tree']}:{r['leaf']}" for r in entries]
    encoder = CountVectorizerModel.from_vocabulary(words, "__words", output, binary=True)
    tokens = F.transform(leaves, lambda leaf, t: F.concat_ws(":", t.cast("string"), leaf.cast("string")))
    return encoder.transform(df.withColumn("__words", tokens)).drop("__words")


def dense_onehot(df: DataFrame, size: int, positions: str = "onehot", output: str = "dense") -> DataFrame:
    """0/1 array of length ``size``."""
    return df.withColumn(output, F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: F.when(F.array_contains(positions, i), 1).otherwise(0)))


# ---------------------------------------------------------------- inspection

def feature_importance(model: DataFrame, kind: str = "weight", feature_map: DataFrame | None = None,
                       index_base: int = 0) -> DataFrame:
    """``(feature, feature_name, importance, order)``, most important first.

    ``kind``: weight (number of splits), gain, cover (means per split), total_gain, total_cover.
    Names come from a ``(feature_id, name)`` map whose ids start at ``index_base`` less than the
    model's; without a name the feature is called ``f<id>``.
    """
    measures = {
        "weight": F.count("*").cast("double"),
        "gain": F.avg("gain"), "total_gain": F.sum("gain"),
        "cover": F.avg("sum_hess"), "total_cover": F.sum("sum_hess"),
    }
    scores = model.filter(~F.col("is_leaf")).groupBy("feature").agg(measures[kind].alias("importance"))
    fallback = F.concat(F.lit("f"), F.col("feature").cast("string"))
    if feature_map is None:
        named = scores.withColumn("feature_name", fallback)
    else:
        names = feature_map.select((F.col("feature_id") + index_base).alias("feature"), "name")
        named = scores.join(names, "feature", "left").withColumn("feature_name", F.coalesce("name", fallback)).drop("name")
    order = Window.orderBy(F.desc("importance"), "feature")
    return named.select("feature", "feature_name", "importance", F.row_number().over(order).alias("order"))


def node_ancestors(spark: SparkSession, model: TreeEnsemble) -> DataFrame:
    """``(tree, leaf, node, leaf_value)``: every node on the path from the root to each leaf."""
    rows = []
    for tree in model.by_tree:
        nodes = {n["node"]: n for n in tree}
        for n in tree:
            at = n["node"] if n["is_leaf"] else -1
            while at >= 0:
                rows.append((n["tree"], n["node"], at, n["leaf_value"]))
                at = nodes[at]["parent"]
    return spark.createDataFrame(rows, "tree int, leaf int, node int, leaf_value double")


def node_sums(df: DataFrame, model: TreeEnsemble, leaves: str = "leaves", hessian: str = "hess") -> DataFrame:
    """``(tree, node, sum_hess, mean)`` of the rows that pass each node.

    ``mean`` is the hessian-weighted mean of the leaf values below the node. Rows are summed per
    leaf first; sums are additive along the path, so no recursion is needed.
    """
    per_leaf = leaf_long(df, leaves, [hessian]).groupBy("tree", "leaf").agg(F.sum(hessian).alias("__h"))
    paths = node_ancestors(df.sparkSession, model)
    return (
        per_leaf.join(F.broadcast(paths), ["tree", "leaf"])
        .groupBy("tree", "node")
        .agg(F.sum("__h").alias("sum_hess"),
             F.try_divide(F.sum(F.col("__h") * F.col("leaf_value")), F.sum("__h")).alias("mean"))
    )


def with_cover(model: DataFrame, sums: DataFrame) -> DataFrame:
    """The model table with ``sum_hess`` replaced by the sums over given rows."""
    found = sums.select("tree", "node", F.col("sum_hess").alias("__h"))
    return model.join(F.broadcast(found), ["tree", "node"], "left").withColumn("sum_hess", F.col("__h")).drop("__h")
