"""Secret scans with corpus-wide ownership: what many owners have is an example, what one owner has looks live.

Tasks find candidates in whole texts: the matches of three fixed patterns, and further runs of token characters that look drawn rather
than written (long, many different characters, letters and digits in turns). Spark then counts, for the hash of each
candidate's value, the distinct repositories and owners of the corpus that have it. Values are combined before they are shuffled, by
value, owner and repository, then by value and owner, so a value that half the corpus copies is spread by its owners and repositories.
Only the hashes of widely copied values come back: they are the few, and they are the hot keys, so while they are few the
join with them moves no rows. The fixed patterns' matches always stay and learn whether they are copied; of the others those stay whose
value few owners have.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import BROADCAST_IDS, broadcast_within, stored

#: Kinds in the order of their listing, patterns and least lengths.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are taken whole, so shorter ones need no match
VALUE, KEY = 8, 16
#: What looks drawn: runs of so many token characters, so many of them different, letter and digit next to each other so often.
RUN = re.compile(r"[A-Za-z0-9+_=-]{20,}")
DIFFERENT = 10
TURN, TURNS = re.compile(r"[0-9][A-Za-z]|[A-Za-z][0-9]"), 3

SPAN = "struct<start:int,k:int,stop:int,hash:binary>"


def _hash(value: str) -> bytes:
    return hashlib.blake2b(value.encode(), digest_size=16).digest()


def drawn(run: str) -> bool:
    """Whether a run of token characters looks drawn at random."""
    return len(set(run)) >= DIFFERENT and len(TURN.findall(run)) >= TURNS


def candidate_spans(text: str) -> list[tuple[int, int, int, bytes]]:
    """(start, kind's number, stop, hash of the value) of all candidates of a text, in code points, by start and kind.

    A kind's matches are the leftmost ones that do not overlap; a match that is too short is dropped and nothing inside it
    tried again. Drawn runs count where no match of the fixed patterns lies in them.
    """
    base = [(m.start(), 0, m.end(), _hash(m[2])) for m in ASSIGN.finditer(text) if len(m[2]) >= VALUE]
    base += [(m.start(), 1, m.end(), _hash(m[0])) for m in ACCESS.finditer(text) if len(m[0]) >= KEY]
    base += [(m.start(), 2, m.end(), _hash(m[0])) for m in HEX.finditer(text)]
    base.sort()
    out, ahead, reach = list(base), 0, 0
    for m in RUN.finditer(text):
        while ahead < len(base) and base[ahead][0] < m.end():
            reach = max(reach, base[ahead][2])
            ahead += 1
        if reach <= m.start() and drawn(m[0]):
            out.append((m.start(), 3, m.end(), _hash(m[0])))
    return sorted(out)


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """(doc_id, owner, repository, spans) of every row; null owners and repositories count as one more, named ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("k", pa.int32()), ("stop", pa.int32()), ("hash", pa.binary())]))
        for batch in batches:
            spans = [[dict(zip(("start", "k", "stop", "hash"), s)) for s in candidate_spans(text.as_py() or "")] for text in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, kind)], names=["doc_id", "owner", "repository", "spans"])

    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), named(owner).alias("owner"), named(repository).alias("repository"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, owner string, repository string, spans array<{SPAN}>")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories): how many distinct ones have each candidate's value."""
    each = found.where(F.size("spans") > 0).select("owner", "repository", F.explode(F.array_distinct(F.transform("spans", lambda s: s["hash"]))).alias("hash"))
    by_owner = each.distinct().groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def secret_spans(docs: DataFrame, owner: str = "source", repository: str = "doc_id", max_owners: int = 2, max_repositories: int | None = None) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text, and the columns named by ``owner`` and ``repository``; further ones are ignored).

    ``spans`` is an array of (start, kind, stop, example) by start and then kind, in code points of the whole text, stops exclusive.
    Kinds assign, access and hex are always there; a drawn run is there as ``owned`` if at most ``max_owners`` distinct owners (and at
    most ``max_repositories`` repositories, if given) of the corpus have its value. ``example`` says that more have it. Null
    and empty texts have no spans. Equal rows are one repository of one owner, each with its own result.
    """
    if max_owners < 1:
        raise ValueError("max_owners must be at least 1")
    found, _ = stored(candidates(docs, owner, repository).withColumn("row", F.monotonically_increasing_id()), "candidates")
    too_many = F.col("owners") > max_owners
    if max_repositories is not None:
        too_many |= F.col("repositories") > max_repositories
    wide, _ = stored(ownership(found).where(too_many).select("hash", F.lit(True).alias("example")), "copied")
    each = found.where(F.size("spans") > 0).select("row", "doc_id", F.explode("spans").alias("s")).select("row", "doc_id", "s.*")
    judged = each.join(broadcast_within(wide, BROADCAST_IDS), "hash", "left").withColumn("example", F.coalesce("example", F.lit(False)))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(F.sort_array(F.collect_list(F.struct("start", "k", "stop", "example"))), lambda s: (s["k"] < 3) | ~s["example"])
    named = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.get(kinds, s["k"]).alias("kind"), s["stop"].alias("stop"), s["example"].alias("example")))
    some = judged.groupBy("row").agg(F.first("doc_id").alias("doc_id"), named.alias("spans"))
    none = found.where(F.size("spans") == 0).select("doc_id", F.expr("cast(array() as array<struct<start:int,kind:string,stop:int,example:boolean>>)").alias("spans"))
    return some.select("doc_id", "spans").unionByName(none)


def listed(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
