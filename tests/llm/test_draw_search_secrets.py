"""Importance resampling, ranked search and secret scans against brute force, on nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("clickforge.llm")

from clickforge.llm import importance, search, secrets  # noqa: E402

DRAW = random.Random(11)
VOCABULARY = [f"t{i}" for i in range(60)] + ["the", "of", "é", "ßx", "9a"]


def prose(n, seed):
    draw = random.Random(seed)
    return " ".join(draw.choice(VOCABULARY) for _ in range(n))


#: Extra columns have the names that the operators use inside.
EXTRA = "row long, rank string, score string, query string, hash string, spans string, b string, n long, part long, place long, item_id string, owner string"
EXTRAS = (1, "x", "x", "x", "x", "x", "x", 1, 1, 1, "x", "x")
DOCS = [
    (1, prose(30, 1), "s1"), (2, prose(25, 2), "s1"), (3, None, "s1"), (4, "", None), (5, " \n-- ", "s2"), (6, "One, two! ONE two", "s2"), (7, prose(400, 7), "s3"),
    (8, prose(30, 1), "s3"), (8, prose(30, 1), "s3"), (9, prose(22, 9), "s4"), (10, "x" * 5000 + " y " + prose(40, 10), None), (None, prose(21, 12), "s4"),
    (11, prose(50_000, 13), "s1"), (-12, prose(30, 1).upper(), "s5"),
]
ITEMS = [(1, prose(12, 1)), (2, "the of nothing"), (3, None), (4, ""), (5, "not there"), (5, "two one"), (None, prose(300, 3)), (7, "x" * 5000 + " t1")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*d, *EXTRAS) for d in DOCS], f"doc_id long, text string, source string, {EXTRA}")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*i, "x", "x") for i in ITEMS], "item_id long, text string, doc_id string, score string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], f"doc_id long, text string, source string, {EXTRA}")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("reach", [4, 7, 64])
def test_position_crc(reach):
    crc, data = importance.PositionCrc(reach), np.frombuffer(DRAW.randbytes(3000), dtype=np.uint8)
    start = np.array([DRAW.randrange(2999) for _ in range(400)])
    stop = np.array([DRAW.choice([i + 1, min(i + reach, 3000), DRAW.randrange(i + 1, 3001)]) for i in start])
    assert crc.of(data, start, stop).tolist() == [zlib.crc32(data[i:j].tobytes()) for i, j in zip(start, stop)]


def expected_draw(docs, target, percent, least, size, buckets):
    features = lambda t: [" ".join(w[i: i + k]) for w in [words_of(t)] for k in range(1, size + 1) for i in range(len(w) - k + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(bucket(f) for text in texts for f in features(text)) for texts in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)}
    rows = []
    for i, text, *_ in docs:
        f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(words_of(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0]))
    drawn = percent * len(order) // 100
    place = collections.defaultdict(list)
    for n, r in enumerate(order, 1):
        place[tuple(r)].append(n if n <= drawn else None)
    return [(*r, place[tuple(r)].pop(0) if r[1] >= least else None) for r in rows]


@pytest.mark.parametrize("percent,size,buckets", [(25, 2, 10_000), (60, 3, 17), (100, 1, 100)])
def test_resampling_brute_force(docs, items, percent, size, buckets):
    got = [tuple(r) for r in importance.resample(docs, items, percent=percent, size=size, buckets=buckets).collect()]
    want = expected_draw(DOCS, [t for _, t in ITEMS], percent, 20, size, buckets)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_resampling_empty_tables(docs, items, none):
    assert importance.resample(none, items).count() == 0
    got = importance.resample(docs, none).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(expected_draw(DOCS, [], 25, 20, 2, 10_000), key=str)


def expected_search(docs, items, top):
    texts = [(i, words_of(t)) for i, t, *_ in docs]
    n = sum(bool(w) for _, w in texts)
    length = sum(len(w) for _, w in texts)
    df = collections.Counter(x for _, w in texts for x in set(w))
    out = []
    for item, text in items:
        terms, scored = set(words_of(text)), []
        for i, w in texts:
            tf, m = collections.Counter(w), 10 + 90 * len(w) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (1_000_000_000 * tf[x] // (1000 * tf[x] + 8 * m)) for x in terms if tf[x])
            scored += [(-score, i is None, i)] if score else []
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored)[:top], 1)]
    return out


@pytest.mark.parametrize("top,coordinates,block", [(10, 4096, 1024), (3, 8, 2), (2, 1, 1)])
def test_search_brute_force(docs, items, top, coordinates, block):
    got = [tuple(r) for r in search.search(docs, items, top, coordinates, block).collect()]
    assert sorted(got, key=str) == sorted(expected_search(DOCS, ITEMS, top), key=str)


def test_search_bounds_hold():
    """No bound is below the exact score, and with few coordinates they are above it."""
    queries = search.Queries.read([0], [prose(20, 5)])
    words = next(search.word_chunks(search.pa.array([t for _, t, *_ in DOCS if t])))
    doc, term, count = search._terms(words)
    weight = np.arange(1, len(queries.terms) + 1)
    sketches = search.Sketches(doc, term, 1000 * count, len(words.rows), queries.terms, 16)
    bounds = sketches.bounds(np.arange(len(weight)), weight)
    exact = sketches.scores(np.arange(len(words.rows)), weight)
    assert (bounds >= exact).all() and (bounds > exact).any() and exact.any()


def test_search_empty_tables(docs, items, none):
    for a, b in ((none, items), (docs, items.where("false")), (docs, items.where("item_id in (3, 4)"))):
        out = search.search(a, b)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


LIVE, COPIED, KEY = "a8Kd02mQzX91vTbE7rLw5", "Zx1Cv2Bn3Mq4Wl5Er6Ty7", "AKIA" + "Z9" * 7
SECRETS = [
    (1, f"see {LIVE} here", "s1"), (2, f"again {LIVE}", "s1"), (3, f"copied {COPIED} {KEY}", "s1"), (4, f"{COPIED}", "s2"), (5, f"{COPIED}, {COPIED}", "s3"), (6, None, "s1"), (7, "", None),
    (8, "password = 'abcdefg' passwd:  \"abcdefgh\" API_KEY=0123456789 apikey : x token=secret:longenough", "s1"), (9, "token: secret: longenough", "s2"),
    (10, f"{'ab01' * 8} AKIA1234 {'0' * 31} é\U0001F600 {'f' * 40}Z token={'c' * 40}", "s3"), (11, "a-long-hyphenated-title-of-2024 " * 3, "s3"), (12, KEY + " " + LIVE.upper() * 3000, None),
    (12, KEY, "s4"), (12, KEY, "s4"), (13, "ſecret = longenough Key toKen=LONGENOUGH", None), (None, KEY, "s1"),
]


def expected_spans(rows, owners_at_most=2):
    found = []
    for i, text, owner in rows:
        t, spans = text or "", []
        at = 0
        while m := re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""").search(t, at):
            at = m.end()
            spans += [(m.start(), 0, m.end(), m[2])] if len(m[2]) >= 8 else []
        spans += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        for m in re.finditer("[A-Za-z0-9+_=-]{20,}", t):
            turns = len(re.findall("[0-9][A-Za-z]|[A-Za-z][0-9]", m[0]))
            if len(set(m[0])) >= 10 and turns >= 3 and not any(k < 3 and a < m.end() and z > m.start() for a, k, z, _ in spans):
                spans.append((m.start(), 3, m.end(), m[0]))
        found.append((i, owner or "", sorted(spans)))
    owners = collections.defaultdict(set)
    for _, owner, spans in found:
        for *_, v in spans:
            owners[v].add(owner)
    name = ("assign", "access", "hex", "owned")
    return [(i, tuple((a, name[k], z, len(owners[v]) > owners_at_most) for a, k, z, v in spans if k < 3 or len(owners[v]) <= owners_at_most)) for i, _, spans in found]


@pytest.mark.parametrize("most", [1, 2, 5])
def test_secrets_brute_force(spark, most):
    rows = spark.createDataFrame([(*d, *EXTRAS) for d in SECRETS], f"doc_id long, text string, source string, {EXTRA}")
    got = [(r.doc_id, tuple(tuple(s) for s in r.spans)) for r in secrets.secret_spans(rows, max_owners=most).collect()]
    want = expected_spans(SECRETS, most)
    assert sorted(got, key=str) == sorted(want, key=str)
    kinds = {s[1] for _, spans in want for s in spans}
    assert kinds >= {"assign", "access", "hex", "owned"} and any(s[3] for _, spans in want for s in spans) == (most < 5)


def test_secrets_by_repositories(spark):
    rows = spark.createDataFrame(SECRETS, "doc_id long, text string, source string")
    kept = lambda **o: {(r.doc_id, s.start) for r in secrets.secret_spans(rows, **o).collect() for s in r.spans if s.kind == "owned"}
    assert kept(max_owners=9) > kept(max_owners=9, max_repositories=2) > kept(max_owners=9, max_repositories=1)


def test_secrets_empty_table(none):
    assert secrets.secret_spans(none).count() == 0
