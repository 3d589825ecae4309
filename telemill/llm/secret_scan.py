"""Secret scan with corpus-wide ownership of each candidate.

Candidates are found per text: the base kinds below, and opaque tokens outside them. How many
distinct owners and repositories hold the same candidate, by hash, tells widely copied examples
from credentials of one owner: an example is held by many owners or in many repositories, a live-looking
secret by one owner in few of them, and what is neither is shared. The method adds the opaque tokens
that look live.

Defined results: a null text counts as the empty text (no span); null owners and repositories count
as one owner and one repository; every row gives one row, so repeated rows stay repeated.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import blocks, texts_of, written

# fixed values: the base kinds, in the order of the output, with the least length of what counts
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "opaque")

OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
LEAST_BITS = 3.0
HIT = "array<struct<kind:int,start:bigint,end:bigint,hash:binary,bits:double>>"


def entropy(value: str) -> float:
    """Bits a character, from the character counts of the value."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) if value else 0.0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, secret) of the base matches, by start and then kind."""
    found = []
    if ":" in text or "=" in text:
        # every match is consumed before its length is judged, as the pattern's leftmost matches
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    # a run is taken whole, so a run that is too short holds no match and can be passed over
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def opaque_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Long tokens of letters and digits with many different characters, clear of the base spans."""
    if not any(len(word) >= 20 for word in text.split()):
        return []
    found = []
    for m in OPAQUE.finditer(text):
        token = m[0]
        mixed = any(c.isdigit() for c in token) and any(c.isalpha() for c in token)
        clear = all(m.end() <= start or m.start() >= end for start, _, end, _ in base)
        if mixed and clear and entropy(token) >= LEAST_BITS:
            found.append((m.start(), 3, m.end(), token))
    return found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        rows = []
        for text in texts_of(batch):
            base = base_spans(text)
            rows.append(
                [
                    {"kind": kind, "start": start, "end": end, "hash": hashlib.sha256(secret.encode()).digest(), "bits": entropy(secret)}
                    for start, kind, end, secret in base + opaque_spans(text, base)
                ]
            )
        kind = pa.list_(
            pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary()), ("bits", pa.float64())])
        )
        rest = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), pa.array(rows, kind)], [*rest, "hits"])


def _spans(hits: Column) -> Column:
    """kind:start:end of each hit, by start and then kind, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    ordered = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("s"), h["kind"].alias("k"), h["end"].alias("e"))))
    texts = F.transform(ordered, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string")))
    return F.array_join(texts, ",")


def scan_secrets(docs: DataFrame, repository: Column, owner: Column, example_owners: int = 3, example_repositories: int = 5) -> DataFrame:
    """A row for each of (doc_id, text): counts, spans, and how its candidates are owned.

    ``n_example`` are the hits whose secret at least ``example_owners`` owners hold or that stands in at least
    ``example_repositories`` repositories, ``n_live`` those that one owner holds in fewer, with characters that
    look random, and ``n_shared`` those of several owners that are no examples. Only candidates are shuffled, as
    distinct (hash, owner, repository) and then as sums; the join of the hits with these sums is a
    plain one that can be split where one example is everywhere.
    """
    texts = docs.select(
        "doc_id", repository.cast("string").alias("repository"), owner.cast("string").alias("owner"), F.col("text").cast("string").alias("text")
    )
    found = texts.mapInArrow(_scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, repository string, owner string, hits {HIT}")
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "secrets")

    hits = found.filter(F.size("hits") > 0).select("row", "owner", "repository", F.explode("hits").alias("hit"))
    hits = hits.select("row", "owner", "repository", "hit", F.col("hit.hash").alias("hash"))
    owned = hits.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one")).groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    owners = owned.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repositories"))
    judged = hits.join(owners, "hash")
    example = (F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories)
    live = ~example & (F.col("n_owners") == 1) & (F.col("hit.bits") >= LEAST_BITS)
    stays = (F.col("hit.kind") < 3) | live
    by_row = judged.groupBy("row").agg(
        F.collect_list(F.when(stays, F.col("hit"))).alias("shown"),
        F.count_if(live).alias("n_live"),
        F.count_if(example).alias("n_example"),
        F.count_if(~example & (F.col("n_owners") > 1)).alias("n_shared"),
        F.max("n_owners").alias("most_owners"),
        F.max("n_repositories").alias("most_repositories"),
    )
    of_kind = lambda k: F.size(F.filter("hits", lambda h: h["kind"] == k)).cast("bigint")
    nothing = F.array().cast(HIT)
    return found.join(by_row, "row", "left").select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        _spans(F.filter("hits", lambda h: h["kind"] < 3)).alias("base_spans"),
        _spans(F.coalesce("shown", nothing)).alias("spans"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_live", "n_example", "n_shared", "most_owners", "most_repositories")],
    )
