"""The corpus pipeline's ``run`` against a brute-force version on small tables."""

import hashlib
import random
import re

import pyarrow as pa
import pytest

pytest.importorskip("clickforge.llm")
tiktoken = pytest.importorskip("tiktoken")

import corpus_pipeline  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickforge.llm import bpe, queries  # noqa: E402
from clickforge.llm.common import BATCH_BYTES, stored  # noqa: E402

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def fixture_rows():
    draw = random.Random(11)

    def line(n=8):
        return " ".join(f"word{draw.randrange(5000)}" for _ in range(n))

    lined = ["\n".join(line() for _ in range(15)) for _ in range(60)]
    flat = [line(120) for _ in range(40)]
    run = "\n".join(lined[0].split("\n")[3:7])
    rows = list(enumerate(lined + flat))
    rows.append((200, "\n".join([line(), line(), run, *(line() for _ in range(9))])))  # loses the run
    rows.append((201, run + "\n" + "\n".join(line() for _ in range(11))))
    rows.append((202, flat[0].rsplit(" ", 1)[0] + " changed"))  # near copy
    rows.append((203, flat[1]))  # exact copy on one line
    rows.append((204, flat[2] + " " + ITEM))  # contaminated
    rows.append((205, lined[1]))  # all lines repeated: nothing is left
    two = flat[3].split(" ")
    two[30], two[70] = "other", "another"
    rows.append((210, " ".join(two)))  # a similarity of 106 / 126: near at 0.8, not at 0.85
    passage = line(20)
    rows.append((211, "\n".join([line(), passage, *(line() for _ in range(9))])))
    rows.append((212, "\n".join([line(), line(), passage, *(line() for _ in range(9))])))  # loses one long line
    rows += [(206, None), (207, ""), (208, "too short"), (209, "the same words " * 50)]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows]


def words(text):
    return (text or "").encode().split()


def brute_force(rows):
    def base(t):
        w = words(t)
        seen = {}
        for p in range(len(w) - 2):
            seen.setdefault(tuple(w[p: p + 3]), []).append(p)
        again = {p + k for places in seen.values() if len(places) > 1 for p in places for k in range(3)}
        return len(w) >= 50 and 100 * len(again) <= 50 * len(w)

    docs = [(i, t) for i, t, *_ in rows if base(t)]
    first, cut = {}, []
    for i, t in sorted(docs):
        held, gone = t.split("\n"), set()
        for a in range(len(held)):
            for n in range(1, min(3, len(held) - a) + 1):
                run = tuple(held[a: a + n])
                if first.setdefault(run, (i, a)) != (i, a) and (n == 3 or len(words(" ".join(run))) >= 13):
                    gone |= set(range(a, a + n))
        left = "\n".join(x for p, x in enumerate(held) if p not in gone)
        if words(left):
            cut.append((i, left))
    sets = {i: {tuple(w[p: p + 5]) for p in range(len(w) - 4)} for i, t in cut if (w := words(t.lower()))}
    near = [(i, t) for i, t in cut if not any(j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in sets)]
    item = ITEM.split()
    windows = [" ".join(item[p: p + 10]) for p in range(len(item) - 9)]
    return [(i, t) for i, t in near if not any(f" {w} " in f" {' '.join(re.findall('[a-z0-9]+', t.lower()))} " for w in windows)]


def test_run_equals_brute_force(spark, tmp_path):
    rows = fixture_rows()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want = brute_force(rows)
    kept = {i for i, _ in want}
    assert set(range(100)) <= kept and {200, 201, 211, 212} <= kept and not kept & {202, 203, 204, 205, 206, 207, 208, 209, 210}
    path, pattern = queries.tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(spark, path), special_tokens={})
    got = {r.doc_id: (list(r.ids), r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got.keys() == kept
    for i, t in want:
        ids = library.encode_ordinary(t)
        assert got[i] == (ids, len(ids), hashlib.sha256(t.encode()).hexdigest())


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_line_stage_removes_long_passages_on_one_line(spark):
    line = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"{line}\none"), (2, f"two\n{line}\nthree"), (3, line), (4, "two")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()} == {1: f"{line}\none", 2: "two\nthree", 4: "two"}


def test_near_stage_removes_copies_from_eight_tenths_on(spark):
    """Two of 100 words changed leave 86 of 106 shingles in common, three leave 81 of 111."""
    base = [f"n{i}" for i in range(100)]
    changed = lambda *at: " ".join("other" + w if i in at else w for i, w in enumerate(base))
    docs = spark.createDataFrame([(1, changed()), (2, changed(30, 60)), (3, changed(20, 50, 80))], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {1, 3}


def test_stages_leave_clashing_columns_alone(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = ["rid", "runs", "gone", "doc", "part", "kept", "h.i"]
    line = " ".join(f"p{i}" for i in range(60))
    texts = [(1, f"{line}\none"), (2, f"two\n{line}\nthree"), (3, f"so {ITEM} it is"), (4, None), (4, None), (None, "own words"), (1, f"{line}\none")]
    rows = [(i, t, "en", "s", -1, *[f"{c}{n}" for c in names]) for n, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` string" for c in names))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes
        for r in out.collect():
            n = int(r.rid[3:])
            assert [r[c] for c in names] == [f"{c}{n}" for c in names] and r.doc_id == texts[n][0]
            assert (r.text, r.n_chars) == ((texts[n][1], -1) if name != "lines" or n != 1 else ("two\nthree", 9))
    assert corpus_pipeline.quality_rules(spark, docs, "").columns == docs.columns


def test_near_stage_goes_by_rows(spark):
    """A row goes if its own text is a copy, whatever its id; of equal rows one stays; empty ones are copies of equal rows only."""
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    rows = [(5, one), (5, two), (1, one + " x"), (7, None), (7, None), (8, ""), (None, two), (None, "own words"), (9, "fine"), (9, "fine")]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    want = [(5, two), (1, one + " x"), (7, None), (8, ""), (None, "own words"), (9, "fine")]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_stored_tables_run_arrow_functions_in_small_batches(spark):
    """12 MB of texts in one partition were one batch; a limit of the session's own holds, and none stays behind."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 3000, 1, 1).select("id", F.repeat(F.lit("text"), 1024).alias("text"))
    made = [r.n for r in stored(texts.mapInArrow(sizes, "n long"), "sizes")[0].collect()]
    assert sum(made) == 3000 and 4096 * max(made) <= 1.1 * BATCH_BYTES
    assert limit not in spark.conf.getAll
    spark.conf.set(limit, 256 << 10)
    try:
        assert 4096 * max(r.n for r in stored(texts.mapInArrow(sizes, "n long"), "sizes")[0].collect()) <= 1.1 * (256 << 10)
        assert int(spark.conf.get(limit).rstrip("b")) == 256 << 10
    finally:
        spark.conf.unset(limit)


def test_byte_pairs_are_made_in_the_stage(spark, sf):
    """What is left to the caller has no Arrow function, which would get the session's large batches."""
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    plans = [corpus_pipeline.byte_bpe(spark, docs, sf), queries.op7_byte_bpe(spark, sf)]
    assert not any("MapInArrow" in df._jdf.queryExecution().toString() for df in plans)
