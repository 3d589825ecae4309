"""Decoding of job descriptions (JDL): never drops a row, never guesses.

A JDL text is either a JSON object or the *body of a JSON string literal* that
holds one. Decoding gives ``map<string,string>``: strings unchanged, JSON null
as NULL, everything else as compact JSON text. A row that does not decode keeps
its original text in ``full_jdl_raw``.

Everything runs as built-in expressions. Only texts the built-in reader refused,
and texts with a token that the JVM prints differently from the JSON authority
(Python's ``json``), are checked by an Arrow UDF; for all others it sees NULL.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.functions.names import PREFIX, jdl_column, snake_column

CANONICAL_KEY = "LPMPassName"

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "mode": "PERMISSIVE"}

# Fixed patterns, searched only in values that are numbers, lists or objects (or
# look like one): exponents, 9+ decimals, overflow to infinity, unicode escapes.
# A pattern is tried only where its letter stands: that search reads bytes.
_SUSPECT = (("E", r"[0-9]E-?[0-9]"), (".", r"[0-9]\.[0-9]{9}"), ("Infinity", None), (r"\u", None))

# Fixed pattern: a whole string of a compact JSON text, with the colon if it is a key. The loops are
# possessive: the JVM runs them without recursion and never goes back into them.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+":?+'

# Fixed patterns: how the text of an object begins, and a quote that ends a string literal. Texts that these
# rule out are not handed to the reader, which pays for each refusal with an exception.
_OBJECT = r'^[ \t\r\n]*+\{[ \t\r\n]*+["}]'
_BARE_QUOTE = r'(?:^|[^\\])"'
_CLOSED = r'\}[ \t\r\n]*+\z'

# Fixed patterns: how the text of an object or the literal body of one begins and ends, escapes included. A refused
# text that these rule out is none for the authority either.
_BEGINS = r'^[ \t\r\n]*+[{\\]'
_ENDS = r'(?:\}|\\u007[dD])(?:[ \t\r\n]|\\[nrt]|\\u00(?:20|09|0[aAdD]))*+\z'

_JDL_MAP = T.MapType(T.StringType(), T.StringType())


def _once(column: Column) -> Column:
    """The same value, computed where it stands.

    A filter above a decode would otherwise be pushed below it with the whole parse
    copied into it. Filters on other columns belong before the decode for the same reason.
    """
    # a condition that always holds and that the optimizer cannot fold, as it folds one on rand()
    return F.when(F.spark_partition_id() >= 0, column)


def _strict(df: DataFrame, body: Column, out: str, literal: bool = False) -> DataFrame:
    """Add ``out``: the body parsed as one complete JSON value, or NULL.

    The reader ignores trailing text, so the body is parsed as ``[body, seal]``
    with a hash of the body as seal: the array has exactly two items and ends in
    the seal only when the body is one complete value. ``literal`` puts the body
    in quotes and gives its text; otherwise it must be an object and gives a map.
    Steps are separate columns so that each text is parsed once.
    """
    seal = F.xxhash64(body).cast("string")
    if literal:
        body = F.when(~body.rlike(_BARE_QUOTE), body)
        text = F.concat(F.lit('["'), body, F.lit('","'), seal, F.lit('"]'))
        kind: T.DataType = T.StringType()
        tail = F.get("_items", 1)
    else:
        closed = F.endswith(body, F.lit("}")) | body.rlike(_CLOSED)
        body = F.when(closed & body.rlike(_OBJECT), body)
        text = F.concat(F.lit("["), body, F.lit(',{"seal":"'), seal, F.lit('"}]'))
        kind = _JDL_MAP
        tail = F.element_at(F.get("_items", 1), "seal")
    items = _once(F.from_json(text, T.ArrayType(kind), _STRICT))
    parsed = df.withColumns({"_seal": seal, "_items": items})
    sealed = (F.size("_items") == 2) & (tail == F.col("_seal"))
    return parsed.withColumn(out, F.when(sealed, F.get("_items", 0))).drop("_seal", "_items")


def json_object(df: DataFrame, text: str, out: str) -> DataFrame:
    """Strict JSON object decode of one text column into a map column."""
    return _strict(df, F.col(text), out).withColumn(out, _once(last_value_wins(F.col(out))))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def last_value_wins(entries: Column) -> Column:
    """Resolve repeated keys of a parsed map: first position, last value.

    Entries are sorted by key, so the work grows with n log n however many keys a map has.
    """
    keys = F.map_keys(entries)

    def item(entry: Column, at: Column) -> Column:
        return F.struct(entry["key"].alias("key"), at.alias("at"), entry["value"].alias("value"))

    def chosen(ordered: Column) -> Column:
        is_first = lambda x, i: F.coalesce(F.get(ordered, i - 1)["key"] != x["key"], F.lit(True))
        is_last = lambda x, i: F.coalesce(F.get(ordered, i + 1)["key"] != x["key"], F.lit(True))
        pairs = F.zip_with(
            F.filter(ordered, is_first),
            F.filter(ordered, is_last),
            lambda first, last: F.struct(first["at"].alias("at"), last["key"].alias("key"), last["value"].alias("value")),
        )
        return _let(F.sort_array(pairs), lambda x: F.map_from_arrays(x["key"], x["value"]))

    resolved = _let(F.sort_array(F.transform(F.map_entries(entries), item)), chosen)
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), resolved).otherwise(entries)


def _is_variant(key: Column) -> Column:
    # the two lengths allow for the single letter that case-folds to "ss"
    folded = F.lower(F.replace(F.replace(key, F.lit("ß"), F.lit("ss")), F.lit("ſ"), F.lit("s")))
    return F.length(key).between(10, 11) & (folded == CANONICAL_KEY.lower())


def merge_case_variants(jdl: Column) -> Column:
    """Coalesce every case variant of the canonical key into that key.

    First non-null value in key order wins; all-null stays NULL.
    """
    others = F.exists(F.map_keys(jdl), lambda k: _is_variant(k) & (k != CANONICAL_KEY))
    variants = F.map_filter(jdl, lambda k, _: _is_variant(k))
    rest = F.map_filter(jdl, lambda k, _: ~_is_variant(k))
    value = F.get(F.filter(F.map_values(variants), lambda v: v.isNotNull()), 0)
    merged = F.map_concat(rest, F.create_map(F.lit(CANONICAL_KEY), value))
    return F.when(others, merged).otherwise(jdl)


def decode_with_json_module(raw: str | None, literal: bool = True) -> dict[str, str | None] | None:
    """The semantic authority for one text: ``None`` when it is not a JDL object."""
    if raw is None:
        return None
    try:
        try:
            value = json.loads(raw)
        except ValueError:
            if not literal:
                return None
            value = json.loads(json.loads(f'"{raw}"'))
    except (ValueError, TypeError, RecursionError):
        return None
    if not isinstance(value, dict):
        return None
    return {
        key: item if item is None or isinstance(item, str) else _compact(item)
        for key, item in value.items()
    }


def _compact(item: object) -> str:
    return json.dumps(item, separators=(",", ":"), ensure_ascii=False)


def _authority(literal: bool):
    @F.arrow_udf(_JDL_MAP)
    def check(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def clean(text: str | None) -> str | None:
            return None if text is None else text.encode("utf-8", "replace").decode("utf-8")

        for texts in batches:
            decoded = [decode_with_json_module(text, literal) for text in texts.to_pylist()]
            maps = [None if d is None else list({clean(k): clean(v) for k, v in d.items()}.items()) for d in decoded]
            yield pa.array(maps, pa.map_(pa.string(), pa.string()))

    return check.asNondeterministic()


def decode_jdl(
    df: DataFrame, column: str = "full_jdl", exact_tokens: bool = True, where: Column | None = None
) -> DataFrame:
    """Replace ``column`` by ``jdl``, ``jdl_parse_ok`` and ``full_jdl_raw``.

    ``where`` is a condition on other columns. It is applied below the parse, which no filter
    above can pass, and so reaches the scan.

    ``exact_tokens=False`` leaves out the Arrow check, for feeds whose values are
    known to hold no exponents, very long numbers, NaN/Infinity or nested escapes.
    Binary texts must be UTF-8 and are never read as a string-literal body.
    """
    df = df if where is None else df.filter(where)
    binary = isinstance(df.schema[column].dataType, T.BinaryType)
    raw = F.col(column)
    work = df.withColumn("_text", F.try_validate_utf8(raw.cast("string"))) if binary else df
    text = F.col("_text") if binary else raw
    work = _strict(work, text, "_direct")
    refused = F.col("_direct").isNull()
    if not binary:
        work = _strict(work, F.when(refused & _may_be_object(text), text), "_body", literal=True)
        work = _strict(work, F.col("_body"), "_second")
        work = work.withColumn("_direct", F.coalesce("_direct", "_second"))
    kept_raw = raw
    if exact_tokens:
        work = work.withColumn("_differs", _once(F.coalesce(F.exists(F.map_values("_direct"), _may_differ), F.lit(False))))
        asked = F.col("_differs") | (refused & _may_be_object(text))
        # rows go past Python with their text only where it may have to stay as it is
        kept_raw = F.col("_kept")
        work = work.withColumns({"_kept": F.when(refused | F.col("_differs"), raw), "_asked": F.when(asked, text)})
        work = work.withColumn("_checked", _authority(not binary)(F.col("_asked")))
        checked = F.when(F.col("_asked").isNotNull(), F.col("_checked"))
        work = work.withColumn("_direct", checked.otherwise(F.col("_direct")))
    work = work.withColumn("_ok", F.col("_direct").isNotNull())
    work = work.withColumn("_direct", _once(last_value_wins(F.col("_direct"))))
    work = work.withColumn("_jdl", _once(merge_case_variants(F.col("_direct"))))
    kept = [c for c in df.columns if c != column]
    return work.select(
        *kept,
        F.col("_jdl").alias("jdl"),
        F.col("_ok").alias("jdl_parse_ok"),
        F.when(~F.col("_ok"), kept_raw).alias("full_jdl_raw"),
    )


def _may_be_object(text: Column) -> Column:
    """False for a text that begins or ends as no object does, neither plain nor as the body of a string literal."""
    begins = F.startswith(text, F.lit("{")) | text.rlike(_BEGINS)
    return begins & (F.endswith(text, F.lit("}")) | text.rlike(_ENDS))


def _may_differ(value: Column) -> Column:
    # first byte: quote, minus, digit, "[" or "{"
    first = F.ascii(value)
    looks_typed = first.between(48, 57) | first.isin(34, 45, 91, 123)
    found = [F.contains(value, F.lit(sign)) & (value.rlike(pattern) if pattern else F.lit(True)) for sign, pattern in _SUSPECT]
    return (looks_typed & reduce(Column.__or__, found)) | (first.isin(91, 123) & F.contains(value, F.lit('":')) & _repeats_key(value))


def _repeats_key(value: Column) -> Column:
    """A key name stands twice in the objects of a value.

    Whether it repeats within one object, and which value then counts, the authority decides.
    """
    keys = F.filter(F.regexp_extract_all(value, F.lit(_STRING), F.lit(0)), lambda text: text.endswith(":"))
    return _let(keys, lambda names: F.size(F.array_distinct(names)) < F.size(names))


def spellings(keys: Iterable[str]) -> dict[str, list[str]]:
    """Flattened column -> the key spellings that normalise to it."""
    found: dict[str, list[str]] = {}
    for key in keys:
        found.setdefault(jdl_column(key), []).append(key)
    return found


def flatten_jdl(df: DataFrame, keys: Iterable[str], column: str = "jdl") -> DataFrame:
    """One string column ``jdl__<name>`` per key, from the map ``column``.

    The key list is fixed before the plan is built (contract and key census), so
    the column set never depends on the rows a run happens to meet. Lists and
    objects are text already and stay value columns.
    """
    kept = [c for c in df.columns if c != column]
    flat = [
        F.coalesce(*[F.element_at(F.col(column), key) for key in group]).alias(name)
        for name, group in spellings(keys).items()
    ]
    return df.select(*kept, *flat)


#: the map column that holds every JDL key without a column of its own
OTHER = "jdl_other"


def flatten_served(df: DataFrame, keys: Iterable[str], column: str = "jdl", other: str = OTHER) -> DataFrame:
    """The columns of ``flatten_jdl`` for the keys given, and all other entries in one map column by their own keys.

    The number of columns does not depend on the rows, however many keys they hold, and no entry is lost. An
    unlisted spelling of a served key counts for its column, behind the listed spellings.
    """
    kept = [c for c in df.columns if c != column]
    groups = spellings(keys)
    known = [key for group in groups.values() for key in group]
    # the name of an entry is asked for only where its spelling is not listed
    spare = df.withColumn("_spare", _once(F.map_filter(F.col(column), lambda k, _: ~k.isin(known))))
    named = lambda k: F.concat(F.lit(PREFIX), snake_column(k))
    odd = F.filter(F.map_entries("_spare"), lambda e: named(e["key"]).isin(list(groups)))
    spare = spare.withColumn("_odd", _once(F.transform(odd, lambda e: F.struct(named(e["key"]).alias("name"), e["value"].alias("value")))))
    # the first value of each name, as a map: every served column looks it up
    filled = F.filter("_odd", lambda e: e["value"].isNotNull())
    first = _let(filled, lambda es: F.filter(es, lambda e, i: F.array_position(es["name"], e["name"]) == i + 1))
    spare = spare.withColumn("_found", _once(F.map_from_entries(first)))

    def served(name: str, group: list[str]) -> Column:
        listed = [F.element_at(F.col(column), key) for key in group]
        return F.coalesce(*listed, F.try_element_at(F.col("_found"), F.lit(name))).alias(name)

    flat = [served(name, group) for name, group in groups.items()]
    rest = F.when(F.size("_odd") > 0, F.map_filter("_spare", lambda k, _: ~named(k).isin(list(groups)))).otherwise(F.col("_spare"))
    return spare.select(*kept, *flat, rest.alias(other))


def entry_of(key: str, columns: Iterable[str], other: str = OTHER) -> Column:
    """The value of a key in a flattened table, wherever it stands: its column, or the map from before it had one."""
    spelled = F.try_element_at(F.col(other), F.lit(key))
    return F.coalesce(F.col(jdl_column(key)), spelled) if jdl_column(key) in set(columns) else spelled
