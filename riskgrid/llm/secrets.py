"""Secret scan with corpus-wide ownership frequency.

Base spans come from three patterns (``assign``, ``access``, ``hex``). Beside them, long mixed
strings of high entropy are candidates that no pattern proves. The hash of each candidate's value
is counted over the whole corpus by distinct repository and owner: a value that many owners hold
is a copied example; one that a single owner holds, in few repositories, and that looks random
is owner-specific and live-looking. Such candidates are added as spans of kind ``token``; base
spans always stay, and are counted as live or copied.

Counting is over distinct (value, owner, repository) rows first, so a value copied into a third
of all rows is combined before it is shuffled. Values leave the scan only as hashes.

Null and empty texts have no spans (empty string, its SHA-256). Null owners and repositories are
one owner and one repository of their own. Repeated rows each get a row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import arrow_map, materialize

KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so the length may stand in the pattern
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
EXAMPLE = re.compile(r"example|sample|dummy|changeme|placeholder|your|xxxx|1234567|abcdef|test", re.I)
MIN_ASSIGN, MIN_ACCESS = 8, 16
MIN_ENTROPY = 3.5
LIVE_OWNERS, LIVE_REPOS = 1, 3


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, value), in order."""
    out = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking strings outside the base spans, with lower case, upper case and digits."""
    out = []
    starts, furthest = [s for s, *_ in base], [0, *accumulate((e for _, _, e, _ in base), max)]
    for m in TOKEN.finditer(text):
        v = m[0]
        if (any(c.isdigit() for c in v) and any(c.islower() for c in v) and any(c.isupper() for c in v)
                and entropy(v) >= MIN_ENTROPY and furthest[bisect_left(starts, m.end())] <= m.start()):
            out.append((m.start(), 3, m.end(), v))
    return out


def looks_live(value: str) -> bool:
    return entropy(value) >= MIN_ENTROPY - 0.5 and not EXAMPLE.search(value)


SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.binary()), ("random", pa.bool_())])


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo: Column) -> DataFrame:
    """One row per document: its spans and candidates with the hashes of their values, no text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            spans = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                spans.append([{"start": s, "kind": k, "end": e, "hash": hashlib.md5(v.encode()).digest(), "random": looks_live(v)}
                              for s, k, e, v in sorted(base + candidates(text or "", base))])
            ids = pa.array(range((task << 36) + row, (task << 36) + row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([ids, batch.column(0), batch.column(2), batch.column(3), pa.array(spans, pa.list_(SPAN))],
                                             names=["row_id", "doc_id", "owner", "repo", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.col(owner_col).cast("string").alias("owner"), repo.cast("string").alias("repo"))
    return arrow_map(rows, run, f"row_id long, doc_id {id_type}, owner string, repo string, "
                                "spans array<struct<start:int,kind:int,end:int,hash:binary,random:boolean>>")


def ownership(scanned: DataFrame) -> DataFrame:
    """Per candidate hash: distinct owners, and distinct repositories of all owners."""
    held = scanned.select("owner", "repo", F.explode("spans.hash").alias("hash")).distinct()
    per_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo: Column | None = None) -> DataFrame:
    """Per document: counts by kind, base spans and all spans, and how many candidates are live or copied.

    Without ``repo``, a repository is an owner's documents in one language.
    """
    repo = F.concat_ws("/", F.col(owner_col), F.col("lang")) if repo is None else repo
    scanned = materialize(scan(docs, id_col, text_col, owner_col, repo), "secret-scan")
    known = ownership(scanned)
    found = scanned.select("row_id", F.explode("spans").alias("s")).select("row_id", "s.*")
    live = F.col("random") & (F.col("n_owners") <= LIVE_OWNERS) & (F.col("n_repos") <= LIVE_REPOS)
    # A value's rows meet its one row of counts; a hot value's rows are split by AQE's skew join.
    judged = found.join(known, "hash").groupBy("row_id").agg(
        F.count_if(live).alias("n_live"), F.count_if(F.col("n_owners") > LIVE_OWNERS).alias("n_copied"),
        F.collect_list(F.when(live & (F.col("kind") == 3), F.struct("start", "kind", "end"))).alias("added"))
    out = scanned.select("row_id", "doc_id", F.filter("spans", lambda s: s["kind"] < 3).alias("base")).join(judged, "row_id", "left")
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    every = F.array_sort(F.concat(plain, F.coalesce(F.col("added"), F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(plain), 256).alias("base_sha256"), _joined(every).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
