"""Quality rules with thresholds from mergeable quantile sketches per language and source.

Instead of fixed cut-offs, each metric gets fences from the quartiles of its group. A KLL sketch is built for every
(language, source) with partial sketches in the tasks; sketches of sources merge to their language and languages to the
corpus, so a group too small to speak for itself borrows the merged one without another pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import ngram_hashes, stored, word_chunks

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

#: Metric: quartile ranges beyond the upper (and, if wanted, lower) quartile, and a margin that a tight group still has.
FENCES = {
    "symbols_per_word": (6.0, 0.15, False),
    "dup_lines_per_10_words": (6.0, 0.35, False),
    "repeat_share": (6.0, 0.30, False),
    "chars_per_word": (6.0, 2.0, True),
}
MIN_GROUP = 200
SKETCH_K = 400


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every row, from whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((5, batch.num_rows), dtype=np.int64)
            texts = batch.column(3)
            for words in word_chunks(texts):
                rows = np.arange(words.rows.start, words.rows.stop)
                out[0, rows] = np.diff(words.first)
                point = np.concatenate([[0], np.cumsum(words.inside & ((words.data & 0xC0) != 0x80))])
                symbol = np.concatenate([[0], np.cumsum(_SYMBOL[words.data])])
                out[1, rows] = np.diff(point[words.text_at])
                out[2, rows] = np.diff(symbol[words.text_at])
                at, grams = ngram_hashes(words, 3)
                doc = words.doc[at]
                order = np.lexsort((grams, doc))
                same = (grams[order][1:] == grams[order][:-1]) & (doc[order][1:] == doc[order][:-1])
                twice = np.zeros(len(at), dtype=bool)
                twice[order[1:]] |= same
                twice[order[:-1]] |= same
                hit = np.zeros(len(words) + 2, dtype=bool)
                for j in range(3):
                    hit[at[twice] + j] = True
                out[4, rows] = np.diff(np.concatenate([[0], np.cumsum(hit[: len(words)])])[words.first])
                for i, row in enumerate(words.rows):
                    lines = [x for x in words.data[words.text_at[i]: words.text_at[i + 1]].tobytes().split(b"\n") if x.split()]
                    out[3, row] = len(lines) - len(set(lines))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *map(pa.array, out)],
                names=["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])

    return docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string")
    ).mapInArrow(run, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")


def _metrics(stats: DataFrame) -> DataFrame:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return stats.withColumns({
        "symbols_per_word": F.col("n_symbols") / n, "dup_lines_per_10_words": F.col("n_dup_lines") / n * F.lit(10.0),
        "repeat_share": F.col("n_repeat_words") / n, "chars_per_word": F.col("word_chars") / n,
    })


def thresholds(stats: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, lo_<metric>, hi_<metric>): the fences that hold for each group of ``stats`` (null is a group).

    A group of fewer than ``min_group`` documents takes the sketch of its language, and that of the corpus if that is small too.
    """
    names = list(FENCES)
    made = _metrics(stats).groupBy("lang", "source").agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(m, F.lit(SKETCH_K)).alias(m) for m in names])
    made, _ = stored(made, "quantiles")

    by_lang = made.groupBy(F.col("lang").alias("of_lang")).agg(
        F.sum("n").alias("l_n"), *[F.kll_merge_agg_double(m).alias(f"l_{m}") for m in names])
    level = by_lang.groupBy(F.lit(1).alias("all")).agg(*[F.kll_merge_agg_double(f"l_{m}").alias(f"a_{m}") for m in names])
    wide = made.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang"))).drop("of_lang").withColumn("all", F.lit(1)).join(level, "all")
    out = []
    for m, (reach, margin, both) in FENCES.items():
        sketch = F.when(F.col("n") >= min_group, F.col(m)).when(F.col("l_n") >= min_group, F.col(f"l_{m}")).otherwise(F.col(f"a_{m}"))
        q1, q3 = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.75))
        beyond = reach * (q3 - q1) + margin
        out += [(q3 + beyond).alias(f"hi_{m}"), ((q1 - beyond) if both else F.lit(float("-inf"))).alias(f"lo_{m}")]
    return wide.select("lang", "source", *out)


def quality_verdicts(docs: DataFrame, min_words: int = 50, repeat_percent: int = 50, min_group: int = MIN_GROUP) -> DataFrame:
    """Statistics and verdict of every row of ``docs`` (doc_id, text, lang, source; further columns are ignored).

    ``base_failed``: fewer than ``min_words`` words, or more than ``repeat_percent`` per cent of them in repeated 3-word windows.
    ``failed`` names the metrics outside their group's fences; ``kept`` is true if neither speaks against the text. Null texts
    count as empty. Null languages and sources are groups of their own. An empty table gives no rows.
    """
    stats, _ = stored(text_statistics(docs), "statistics")
    fences = thresholds(stats, min_group).withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    judged = _metrics(stats).join(
        fences, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    failed = F.array_compact(F.array(*[
        F.when((F.col(m) > F.col(f"hi_{m}")) | (F.col(m) < F.col(f"lo_{m}")), F.lit(m)) for m in FENCES]))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return judged.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), failed.alias("failed"), (~base & (F.size(failed) == 0)).alias("kept"))
