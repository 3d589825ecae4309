"""Line-first quality cleaning with DataFrame functions only.

Each line is judged by itself: shouted or unpunctuated fragments, navigation lines and boilerplate
are removed, then a document that lost too much of its text is rejected. The base counts are
taken from the text as it came.

Defined results: a null text counts as the empty text (no words, rejected, cleaned to the empty
text; a null stays null in ``clean_documents``); rows are independent, so repeated rows, null ids
and further columns change nothing; an empty table gives an empty table. Lines of any length are
judged whole: patterns repeat possessively, so that they take linear time and no stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import free_name, let, text_or_empty

WORDS = r"[^ \t\n\x0B\f\r]"
BLANKS = r"[ \t\n\x0B\f\r]+"
#: within a line: a blank, what is none, what is neither blank nor letter, and that without ! and ?
W, NW, MARK, LONE = [r"[%s \t\x0B\f\r]" % of for of in ("", "^", r"^\p{L}", r"^\p{L}!?")]


@dataclass(frozen=True)
class LineRules:
    """A line fails if it matches a pattern, holds a phrase, is made of marked words or of linked items, or shouts.

    A document may lose ``most_lost`` of its characters. The patterns are applied one by one: a pattern that
    begins with a character class passes over a line quickly. A word is marked if it holds ``marked``; a line of
    at least three marked words fails if half of its words are. A line with at least four ``bars`` fails if
    there are at most three words to two items, none of them like code or numbers, unless it begins and ends
    with a bar as the row of a table does.
    """

    navigation: str = (
        rf"^{W}*+(?:(?i:home|menu|login|log in|sign (?:in|up)|register|search|next|previous|prev|back(?: to top)?|top|"
        r"contact(?: us)?|about(?: us)?|faq|help|sitemap|share|tweet|print|skip to content|read more|click here)"
        rf"(?:{W}*+[|>»/·•-]++{W}*+|{W}*+\z))++\z"
    )
    #: two marks, behind which no letter stands before the next blank; sought from the beginning of each run without letters
    emphasis: str = rf"(?<!{MARK})(?:{LONE}|[!?](?![!?]))*+[!?]{{2}}{MARK}*+(?:{W}|\z)"
    punctuation: tuple[str, ...] = (
        r"[.,;:]{4}", r"^[^\p{L}\p{N}]++\z",
        r"[cC](?i:opyright) \d{4}", rf"©{W}*+\d{{4}}",  # footers with a year
    )
    marked: str = r"[#$%&*]{3}"
    bars: str = r"[|»•·]"
    code: str = r"""[\p{N}=_/\\`"'$<>{}()\[\]~&;-]"""
    boilerplate: tuple[str, ...] = (
        "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "uses cookies",
        "accept cookies", "accept all cookies", "copyright (c)", "copyright ©", "powered by", "enable javascript",
        "lorem ipsum", "subscribe to our",
    )
    shout_letters: int = 20
    shout_percent: int = 70
    most_lost: float = 0.5


def base_counts(text: Column) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text that is not null."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORDS))

    def repeats(w: Column) -> Column:
        def windows(h: Column) -> Column:
            triple = lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))
            return F.transform(F.slice(h, 1, F.size(h) - 2), lambda x, i: F.struct(triple(x, i).alias("h"), i.alias("i")))

        # sort_array orders by value; array_sort would call a comparison for each pair
        ordered = let(F.transform(w, lambda word: F.xxhash64(word)), lambda h: F.sort_array(windows(h)))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(let(ordered, _covered))

    def counts(packed: Column, w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.when(F.size(w) > 0, F.length(packed) - F.size(w) + 1).otherwise(0).cast("bigint").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            repeats(w).cast("bigint").alias("n_repeat_words"),
        )

    nothing = F.array().cast("array<string>")
    words = lambda packed: F.when(packed == "", nothing).otherwise(F.split(packed, " "))
    return let(F.trim(F.regexp_replace(text, BLANKS, " ")), lambda packed: let(words(packed), lambda w: counts(packed, w)))


def _covered(ordered: Column) -> Column:
    """Words under windows that equal another one; windows come ordered by (hash, position)."""

    def twin(x: Column, i: Column) -> Column:
        # a hash beyond either end is null, which equals no other
        return (F.get(ordered, i - 1)["h"] == x["h"]) | (F.get(ordered, i + 1)["h"] == x["h"])

    found = F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))
    gaps = lambda p: F.transform(p, lambda x, i: F.least(F.lit(3), x - F.coalesce(F.get(p, i - 1), x - 3)))
    # a window adds the words after those of the window before it
    return let(found, lambda p: F.aggregate(gaps(p), F.lit(0), lambda total, gap: total + gap))


def line_fails(line: Column, rules: LineRules) -> Column:
    """True for a line that a rule removes; blank lines stay."""
    # letters are counted only where enough capitals stand for the smallest line that shouts
    capitals = rules.shout_letters * rules.shout_percent // 100 + 1
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    share = 100 * F.regexp_count(line, F.lit(r"\p{Lu}")) > rules.shout_percent * letters
    shouts = line.rlike(rf"(\p{{Lu}}\P{{Lu}}*+){{{capitals}}}") & (letters >= rules.shout_letters) & share
    fails = line.rlike(rules.navigation) | line.rlike(rules.emphasis) | shouts
    for pattern in rules.punctuation:
        fails = fails | line.rlike(pattern)
    words = F.regexp_count(line, F.lit(f"{NW}++"))
    marked = F.regexp_count(line, F.lit(f"{rules.marked}{NW}*+"))
    fails = fails | (line.rlike(rules.marked) & (marked >= 3) & (2 * marked >= words))
    bars = F.regexp_count(line, F.lit(rules.bars))
    linked = F.regexp_count(line, F.lit(f"[^{rules.bars[1:-1]}{W[1:-1]}]++"))
    row = line.rlike(rf"^{W}*+\|") & line.rlike(rf"\|{W}*+\z")
    fails = fails | (line.rlike(rules.bars) & (bars >= 4) & (2 * linked <= 3 * (bars + 1)) & ~line.rlike(rules.code) & ~row)
    held = lambda small: F.exists(F.array(*[F.lit(p) for p in rules.boilerplate]), lambda p: F.contains(small, p))
    return line.rlike(WORDS) & (fails | let(F.lower(line), held))


def judged(docs: DataFrame, rules: LineRules = LineRules(), column: str = "text", into: str = "quality") -> DataFrame:
    """The frame with struct column ``into``: the base counts, base_failed, clean_text, lost, kept.

    A column that already has that name is replaced.
    """
    text = text_or_empty(column)
    lines = F.filter(F.split(text, "\n"), lambda line: ~line_fails(line, rules))
    # exploding the one value keeps the optimizer from copying it into every use of its fields
    measured = let(base_counts(text), lambda counts: counts.withField("clean_text", F.array_join(lines, "\n")))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != into]
    return docs.select(*kept, F.explode(F.array(measured)).alias(into)).withColumn(into, _verdict(F.col(into), text, rules))


def _verdict(quality: Column, text: Column, rules: LineRules) -> Column:
    failed = (quality["n_words"] < 50) | (100 * quality["n_repeat_words"] > 50 * quality["n_words"])
    left = F.length(F.regexp_replace(quality["clean_text"], BLANKS, "")).cast("bigint")
    lost = F.when(quality["clean_text"] == text, F.lit(0).cast("bigint")).otherwise(quality["word_chars"] - left)
    kept = ~failed & (lost <= quality["word_chars"] * rules.most_lost)
    return quality.withField("base_failed", failed).withField("lost", lost).withField("kept", kept)


def clean_documents(docs: DataFrame, rules: LineRules = LineRules(), column: str = "text") -> DataFrame:
    """The documents that pass, with the columns they came with and their failing lines removed."""
    into = free_name(docs, "quality")
    kept = judged(docs, rules, column, into=into).filter(F.col(into)["kept"])
    out = kept.withColumn(column, F.when(F.col(column).isNotNull(), F.col(into)["clean_text"]))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(column).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
