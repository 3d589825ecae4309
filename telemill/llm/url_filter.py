"""URL filter: host rules first, then the likelihood ratio of two character Markov models.

The rules label the addresses they fit. Two smoothed variable-order models, one of allowed and one
of blocked addresses, are counted over all labelled rows but a fold that calibrates the threshold
of the length-normalised log-likelihood difference. Folds are dealt by what the models read of an address, so
that none of the held-out ones was counted, and there each such shape counts once. The verdict of the other
addresses is the model's.

Defined results: an address that is null or has no ``://`` has an empty host and path, no rule, and
is blocked; with no allowed or no blocked address to learn from, what no rule fits is allowed.
Every row is judged by itself, so repeated rows and null ids stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import free_name, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\x02", "\x03"
ORDER = 5
LABELS = ("allow", "block")
PRIOR = 4.0
ALPHABET = 96
FOLDS = 5
STEP, REACH = 0.01, 8.0
UNIT = 1e9

Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def with_rules(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """The frame with host, path, rule and the rule's verdict; of the rules that fit the longest wins."""
    host, path = host_and_path(F.col(url))
    out = pages.withColumns({"host": host, "path": path})
    best = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col("path").startswith(rule_path)
        best = F.when(fits, rule_host + rule_path).otherwise(best[0]), F.when(fits, verdict).otherwise(best[1])
    return out.withColumns({"rule": best[0], "_ruled_": best[1]})


def _shape(host: Column, path: Column) -> Column:
    """What the models read: host and path, with each digit as 0 and unusual characters as ?."""
    shape = F.regexp_replace(F.lower(F.concat(host, path)), "[0-9]", "0")
    return F.regexp_replace(shape, r"[^\x20-\x7e]", "?")


def fold_of(shape: Column) -> Column:
    """The fold of all addresses of a shape; fold 0 is held out."""
    return F.pmod(F.xxhash64(shape), F.lit(FOLDS))


def _grams(shape: Column) -> Column:
    """Each character of a shape, and its end, behind the ORDER characters before it."""
    padded = F.concat(F.lit(START * ORDER), shape, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(shape) + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))


def _keys(gram: Column, count: Callable[[int], Column], total: Callable[[int], Column]) -> Column:
    """One struct for each n-gram that ends a longest one, and one for each context before its last character."""
    ends = [F.struct(F.right(gram, F.lit(k + 1)).alias("key"), count(k).alias("of")) for k in range(ORDER + 1)]
    context = F.left(gram, F.lit(ORDER))
    return F.array(*ends, *[F.struct(F.right(context, F.lit(k)).alias("key"), total(k).alias("of")) for k in range(ORDER + 1)])


def gram_counts(shapes: DataFrame) -> DataFrame:
    """(key, allow, block, after_allow, after_block): how often each text of up to ORDER + 1 characters
    stands in labelled shapes, and how often it stands there before a character.

    Nothing is left out. The longest n-grams are counted over all shapes; the shorter ones are sums of those counts.
    """
    counted = shapes.filter("allow + block > 0").select("allow", "block", F.explode(_grams(F.col("_shape_"))).alias("gram"))
    longest = counted.groupBy("gram").agg(*[F.sum(label).alias(label) for label in LABELS])
    names, none = [*LABELS, *[f"after_{label}" for label in LABELS]], F.lit(0).cast("bigint")
    counts = [F.col(label) for label in LABELS]
    of = lambda values: F.struct(*[v.alias(n) for v, n in zip(values, names)])
    keys = _keys(F.col("gram"), lambda k: of([*counts, none, none]), lambda k: of([none, none, *counts]))
    every = longest.select(F.explode(keys).alias("x")).select("x.key", "x.of.*")
    return every.groupBy("key").agg(*[F.sum(name).alias(name) for name in names])


def _ratios(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, ratio): log-probability of each n-gram's last character by the allow model less that by the block model.

    A probability backs off to shorter contexts where a context is rare. Ratios are whole numbers of
    1 / UNIT, so that sums do not depend on the order of rows.
    """
    place = lambda k: F.lit(k)
    asked = grams.select("gram", F.explode(_keys(F.col("gram"), place, lambda k: F.lit(ORDER + 1 + k))).alias("x"))
    asked = asked.select("gram", "x.key", F.col("x.of").alias("place"))
    # texts of up to two characters are few, whatever the input, and almost every n-gram asks for them
    short = asked.filter(F.length("key") <= 2).join(F.broadcast(counts.filter(F.length("key") <= 2)), "key")
    long = asked.filter(F.length("key") > 2).join(counts.filter(F.length("key") > 2), "key")
    at = lambda name, k: F.coalesce(F.sum(F.when(F.col("place") == k, F.col(name))), F.lit(0))
    values = [at(label, k).alias(f"n_{label}_{k}") for label in LABELS for k in range(ORDER + 1)]
    values += [at(f"after_{label}", ORDER + 1 + k).alias(f"of_{label}_{k}") for label in LABELS for k in range(ORDER + 1)]
    found = short.unionByName(long).groupBy("gram").agg(*values)
    logs = []
    for label in LABELS:
        p = F.lit(1 / ALPHABET)
        for k in range(ORDER + 1):
            # a context that was never seen has no count either and leaves p as it is
            p = (F.col(f"n_{label}_{k}") + PRIOR * p) / (F.col(f"of_{label}_{k}") + PRIOR)
        logs.append(F.log(p))
    return found.select("gram", F.round((logs[0] - logs[1]) * UNIT).cast("bigint").alias("ratio"))


def _scored(shapes: DataFrame, counts: DataFrame) -> DataFrame:
    """The shapes with column score: the mean log-likelihood of allow less that of block."""
    asked = shapes.select("_place_", F.explode(_grams(F.col("_shape_"))).alias("gram"))
    ratios = _ratios(asked.select("gram").distinct(), counts)
    scores = asked.join(ratios, "gram").groupBy("_place_").agg((F.sum("ratio") / F.count("*") / UNIT).alias("score"))
    return shapes.join(scores, "_place_")


def _threshold(held_out: DataFrame) -> float:
    """The score that separates the held-out labels best, in steps; the mean of both error rates counts."""
    step = F.round(F.least(F.lit(REACH), F.greatest(F.lit(-REACH), F.col("score"))) / STEP).cast("int").alias("step")
    sums = [F.count_if(F.col(f"held_{label}") > 0).alias(label) for label in LABELS]
    rows = held_out.groupBy(step).agg(*sums).collect()  # at most 2 * REACH / STEP + 1 rows
    places = int(REACH / STEP)
    n = {label: np.zeros(2 * places + 1) for label in LABELS}
    for row in rows:
        for label in LABELS:
            n[label][row.step + places] = row[label]
    if not n["allow"].sum() or not n["block"].sum():
        return 0.0
    # allowed from a step on: what is allowed below it and blocked from it on is wrong
    wrong = np.concatenate([[0], np.cumsum(n["allow"])[:-1]]) / n["allow"].sum()
    wrong += np.cumsum(n["block"][::-1])[::-1] / n["block"].sum()
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float((best[np.abs(best - places).argmin()] - places - 0.5) * STEP)


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """The frame with host, path, rule, score (null where a rule decides) and verdict.

    Columns that already have these names are replaced. The counts of all n-grams and the distinct shapes
    are tables in the shared folder; the driver sees two totals and one histogram of scores.
    """
    rest = ["host", "path", "rule"]
    # columns named like those inside step aside until the end
    aside = {c: free_name(pages, c) for c in pages.columns if c.lower() in ("_shape_", "_ruled_", "_place_")}
    names = [F.col(f"`{aside.get(c, c)}`").alias(c) for c in pages.columns if c not in (*rest, "score", "verdict")]
    pages = pages.drop("score", "verdict").withColumnsRenamed(aside)
    ruled = with_rules(pages, rules, aside.get(url, url)).withColumn("_shape_", _shape(F.col("host"), F.col("path")))
    usable = (F.col("host") != "") | (F.col("path") != "")
    is_open = F.col("_ruled_").isNull() & usable
    fold = fold_of(F.col("_shape_"))
    rows = [F.count_if((F.col("_ruled_") == label) & (fold > 0)).alias(label) for label in LABELS]
    rows += [F.count_if((F.col("_ruled_") == label) & (fold == 0)).alias(f"held_{label}") for label in LABELS]
    shapes = ruled.filter(F.col("_ruled_").isNotNull() | usable).groupBy("_shape_").agg(*rows, F.count_if(is_open).alias("open"))
    # the place of a stored row does not change when it is read again
    shapes = written(shapes.withColumn("_place_", F.monotonically_increasing_id()), "shapes")
    counts = written(gram_counts(shapes), "grams")
    totals = counts.filter("key = ''").first()
    if totals is None or not totals.after_allow or not totals.after_block:
        judged, verdict = ruled.withColumn("score", F.lit(None).cast("double")), F.lit("allow")
    else:
        scored = written(_scored(shapes.filter("held_allow + held_block + open > 0"), counts), "scores")
        threshold = _threshold(scored.filter("held_allow + held_block > 0"))
        known = scored.filter("open > 0").select("_shape_", "score")
        decided = ruled.filter(~is_open).withColumn("score", F.lit(None).cast("double"))
        judged = ruled.filter(is_open).join(known, "_shape_").unionByName(decided)
        verdict = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return judged.select(*names, *rest, "score", F.coalesce("_ruled_", F.when(~usable, "block"), verdict).alias("verdict"))
