"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Tokens are canonical: those with a digit become ``<num>``, a unit after one ``<unit>``,
capitalised words ``<name>``; others are lower-cased without the punctuation
at their end. A second form of each text, *folded*, has no ``<name>``: all but numbers and
units is lower-cased (and ß is ss, as in capitals), so that copies in capitals or without them are found.
Both forms are looked up; what follows holds for each. Templates are windows of ``window`` canonical tokens; those of the
benchmark with at least ``literals`` plain tokens are looked up in the documents' windows
by a hash join. Hits on one diagonal (document position minus item position) cover
tokens of the item; where these are enough (``half`` of the item, or ``run`` tokens),
the canonical tokens are compared themselves and the slots' values are matched: one
value of the item stands for one value of the document and the other way round,
but for a share ``1 - consistent``. So verbatim passages and re-parameterised ones
are found, and chance templates with contradicting slots are not.

An item whose templates cover too few of its own tokens for that (short ones, those dense
in numbers and names, text without spaces) is looked up whole: as its sequence of words
and other characters, case-folded, numbers as they stand, without the punctuation at its
end; letters of scripts without spaces are words of their own. A sequence is hashed as
two of the largest power of two within its length, so all lengths share the same hashes.

The benchmark's windows are written first, so that Spark knows their size and
broadcasts them while they are small; beyond that the join shuffles, and a template
of many documents is split by AQE. A document's windows leave the task only
if they hit. Texts are read again for documents with hits alone.

Cases: null or empty texts hit nothing; an item of one word hits every text with that
word; repeated items are one item each; rows of one key are one document and join
their hits; a row with a null key is reported under the null key once; other columns are not
read. A window whose tokens are nearly all placeholders is never a template; items made of
such windows are found only where they stand whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import Tables, fresh_name

# Units that may follow a number.
UNITS = (
    "mm", "cm", "dm", "m", "km", "in", "inch", "inches", "ft", "foot", "feet", "yd", "yards", "mile",
    "miles", "meter", "meters", "metre", "metres", "mg", "g", "kg", "t", "gram", "grams", "oz", "lb",
    "lbs", "pound", "pounds", "ml", "cl", "l", "liter", "liters", "litre", "litres", "s", "sec",
    "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week",
    "weeks", "month", "months", "year", "years", "percent", "degrees", "dollar", "dollars", "cent",
    "cents", "euro", "euros", "mph", "kmh", "w", "kw", "j", "n", "pa", "hz", "v", "a", "k", "c", "f",
)


@dataclass(frozen=True)
class Spec:
    window: int = 10
    literals: int = 6
    half: float = 0.5
    run: int = 20
    consistent: float = 0.8


def raw_tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, r"\s+"), "")


def _fold(text: Column) -> Column:
    """Lower case; letters that go through upper case as others are these."""
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


# The patterns of whole tokens go on from the last match (``\G``) over the tokens between,
# which they keep: looking behind at each character takes several times as long.


def _plain(text: Column) -> Column:
    """The text with its numbers and units replaced, without the punctuation at tokens' ends."""
    units = "|".join(UNITS)
    out = F.regexp_replace(text, r"\G((?:[^\s0-9]*+\s)*+)[^\s0-9]*+[0-9]\S*+", "$1<num>")
    out = F.regexp_replace(out, rf"(?i)(<num>\s)(?:{units})(?=[.,;:!?)]*(?:\s|\z))", "$1<unit>")
    # the marks first, so that only they are looked behind
    return F.regexp_replace(out, r"[.,;:!?)\"'](?<=\S.)[.,;:!?)\"']*+(?=\s|\z)", "")


def _named(plain: Column) -> Column:
    other = r"[^\s\p{L}<]*+(?:[\p{L}<&&[^\p{Lu}]]\S*+)?+\s"
    return F.regexp_replace(plain, rf"\G((?:{other})*+)[^\s\p{{L}}<]*+\p{{Lu}}\S*+", "$1<name>")


def _canonical(plain: Column) -> Column:
    return raw_tokens(F.lower(_named(plain)))


def canonical_tokens(text: Column) -> Column:
    """As many tokens as ``raw_tokens`` gives."""
    return _canonical(_plain(text))


def _by_form(df: DataFrame, name: str) -> DataFrame:
    """Two rows for one: ``folded`` (0 or 1) and the tokens of ``text`` in that form."""
    plain = F.col("_plain")
    forms = F.array(_canonical(plain), raw_tokens(_fold(plain)))
    return df.withColumn("_plain", _plain(F.col("text"))).select(
        *df.columns, F.posexplode(forms).alias("folded", name)
    )


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _window(tokens: Column, at: Column, spec: Spec) -> Column:
    """Hash of the window that starts ``at`` tokens from the first."""
    return F.xxhash64(F.slice(tokens, at + 1, F.lit(spec.window)))


def _windows(tokens: Column, spec: Spec) -> Column:
    """Hashes of the windows, in order."""
    last = F.size(tokens) - spec.window
    starts = F.when(last >= 0, F.sequence(F.lit(0), last))
    return F.transform(starts, lambda at: _window(tokens, at, spec))


def _text_windows(texts: DataFrame, spec: Spec) -> DataFrame:
    """``key, folded, pos, hash`` of each window. Rows of single tokens and no lambda functions:
    Spark compiles these steps, the join that follows included, and interprets lambda functions."""
    tokens = F.col("tokens")
    return (
        _by_form(texts, "tokens")
        .select("key", "folded", "tokens", F.posexplode(tokens).alias("pos", "token"))
        .where(F.col("pos") <= F.size(tokens) - spec.window)
        .select("key", "folded", "pos", _of_form(_window(tokens, F.col("pos"), spec)).alias("hash"))
    )


def _of_form(hashed: Column) -> Column:
    """One key for window and form."""
    return F.xxhash64(hashed, F.col("folded"))


def _is_slot(token: Column) -> Column:
    return token.isin("<num>", "<unit>", "<name>")


def _templates(items: DataFrame, spec: Spec) -> DataFrame:
    """``hash, item, folded, at`` of the benchmark's windows with enough plain tokens."""
    return (
        items.select("item", "folded", "tokens", F.posexplode(_windows(F.col("tokens"), spec)))
        .withColumn("own", F.slice("tokens", F.col("pos") + 1, spec.window))
        .where(F.size(F.filter("own", lambda t: ~_is_slot(t))) >= spec.literals)
        .select(_of_form(F.col("col")).alias("hash"), "item", "folded", F.col("pos").alias("at"))
    )


def _enough(spec: Spec) -> Column:
    return F.least(
        F.lit(spec.run), F.greatest(F.lit(spec.window), F.ceil(F.size("tokens") * spec.half))
    )


def _covered(starts: Column, spec: Spec) -> Column:
    """The tokens in windows at ``starts``."""
    return F.array_distinct(
        F.flatten(F.transform(starts, lambda s: F.sequence(s, s + (spec.window - 1))))
    )


def _words(text: Column) -> Column:
    """Words and other characters, case-folded."""
    scripts = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
    alone = "".join(rf"\p{{Is{s}}}" for s in scripts)
    word = rf"[{alone}]\p{{M}}*|[\p{{L}}\p{{N}}\p{{M}}&&[^{alone}]]+|\S"
    return F.regexp_extract_all(_fold(text), F.lit(word), F.lit(0))


def _sequences(words: Column, lengths: Column, most: int) -> Column:
    """Hashes of the sequences of ``lengths`` words, none above ``most``."""

    def pair(level: Column, length: Column, shift: Column) -> Column:
        count = F.greatest(F.size(level) - shift, F.lit(0))
        return F.zip_with(
            F.slice(level, F.lit(1), count), F.slice(level, shift + 1, count),
            lambda a, b: F.xxhash64(length, a, b),
        )

    def double(levels: Column, span: Column) -> Column:
        last = _let(F.element_at(levels, -1), lambda level: pair(level, span * 2, span))
        return F.concat(levels, F.array(last))

    levels = F.array(F.transform(words, lambda w: F.xxhash64(w)))  # of 1, 2, 4 ... words
    spans = [1 << k for k in range(most.bit_length() - 1)]
    if spans:
        levels = F.aggregate(F.array(*map(F.lit, spans)), levels, double)

    def of(levels: Column, length: Column) -> Column:
        digits = F.length(F.bin(length))
        shift = length - F.pow(F.lit(2), digits - 1).cast("int")
        return _let(F.element_at(levels, digits), lambda level: pair(level, length, shift))

    return _let(levels, lambda l: F.array_distinct(F.flatten(F.transform(lengths, lambda n: of(l, n)))))


def _whole_leaks(own: DataFrame, items: DataFrame, spec: Spec, tables: Tables) -> DataFrame | None:
    """Leaks of the items that templates do not cover; None if all are covered."""
    tokens = F.col("tokens")

    def is_template(start: Column) -> Column:
        window = F.slice(tokens, start + 1, spec.window)
        return (F.size(window) == spec.window) & (
            F.size(F.filter(window, lambda t: ~_is_slot(t))) >= spec.literals
        )

    # without the first token: after a number of the document it may be a unit there
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1))), is_template)
    bare = F.regexp_replace("text", r"[\s.,;:!?)\"'。，、；：！？」』）]+\z", "")
    sought = (
        items.groupBy("item", "text")
        .agg(
            F.max(F.size(_covered(starts, spec)) >= _enough(spec)).alias("usable"),
            F.max(F.size(tokens)).cast("long").alias("n_item_tokens"),
        )
        .where(~F.col("usable"))
        .select("item", "n_item_tokens", _words(F.when(bare == "", F.col("text")).otherwise(bare)).alias("words"))
        .where("size(words) > 0")
    )
    sought = tables.write(sought, "whole-items")
    lengths = sorted(r.n for r in sought.select(F.size("words").alias("n")).distinct().collect())
    if not lengths:
        return None
    hashed = sought.select(
        "item", "n_item_tokens", F.explode(_sequences(F.col("words"), F.array(F.size("words")), lengths[-1])).alias("hash")
    )
    hashed = tables.write(hashed, "whole-hashes")
    every = F.array(*map(F.lit, lengths))
    found = own.select("key", F.explode(_sequences(_words(F.col("text")), every, lengths[-1])).alias("hash"))
    return (
        found.join(hashed, "hash")
        .select(
            "key", "item", F.col("n_item_tokens").alias("n_matched"), "n_item_tokens", F.lit(True).alias("exact")
        )
        .distinct()
    )


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", spec: Spec = Spec(),
) -> DataFrame:
    """Per leaked item and document: ``key, item, n_matched, n_item_tokens, exact``."""
    tables = Tables(docs.sparkSession)
    sought = (
        benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
        .where("item is not null and text is not null")
        .distinct()
        .withColumn("raw", raw_tokens(F.col("text")))
    )
    items = tables.write(_by_form(sought, "tokens"), "items")
    templates = tables.write(_templates(items, spec), "templates")
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    hits = (
        _text_windows(own, spec).select("key", "pos", "hash")
        .join(templates, "hash")
        .select("key", "item", "folded", (F.col("pos") - F.col("at")).alias("shift"), "at")
        .groupBy("key", "item", "folded", "shift")
        .agg(F.collect_set("at").alias("starts"))  # at most as many as the item has windows
    )
    hits = tables.write(hits, "hits")
    enough = _enough(spec)
    covered = _covered(F.col("starts"), spec)
    spans = (
        hits.join(items, ["item", "folded"])
        .select("key", "item", "folded", "shift", covered.alias("covered"), "tokens", "raw")
        .where(F.size("covered") >= enough)
    )
    texts = own.join(
        hits.select(F.col("key").alias("hit")).distinct(), F.col("key").eqNullSafe(F.col("hit")), "left_semi"
    )
    texts = _by_form(texts, "doc_tokens").select(
        F.col("key").alias("own"),
        raw_tokens(F.col("text")).alias("doc_raw"),
        "doc_tokens",
        F.col("folded").alias("form"),
    )

    def at(array: str, position: Column) -> Column:
        return F.try_element_at(F.col(array), (position + 1).cast("int"))

    same = F.filter(
        "covered", lambda p: (p + F.col("shift") >= 0) & (at("tokens", p) == at("doc_tokens", p + F.col("shift")))
    )
    slots = F.transform(
        F.filter("same", lambda p: _is_slot(at("tokens", p))),
        lambda p: F.struct(
            at("tokens", p).alias("kind"),
            _value(at("raw", p)).alias("asked"),
            _value(at("doc_raw", p + F.col("shift"))).alias("found"),
        ),
    )
    pairs = F.array_distinct("slots")
    left = F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["asked"])))
    right = F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["found"])))
    on_own = F.col("key").eqNullSafe(F.col("own")) & (F.col("folded") == F.col("form"))
    exact = F.forall("slots", lambda s: s["asked"] == s["found"])
    leaks = (
        spans.join(texts, on_own)
        .withColumn("same", same)
        .where(F.size("same") >= enough)
        .withColumn("slots", slots)
        .where(F.size(pairs) * spec.consistent <= F.least(F.size(left), F.size(right)))
        .groupBy("key", "item", "shift")
        .agg(
            F.max(F.size("same")).cast("long").alias("n_matched"),
            F.max(F.size("tokens")).cast("long").alias("n_item_tokens"),
            # names are no slots of the folded form, so the other one decides where it hits
            F.coalesce(F.max(F.when(F.col("folded") == 0, exact)), F.max(exact)).alias("exact"),
        )
        .drop("shift")
    )
    whole = _whole_leaks(own, items, spec, tables)
    if whole is not None:
        leaks = leaks.unionByName(whole)
    return (
        leaks.groupBy("key", "item")
        .agg(*[F.max(c).alias(c) for c in ("n_matched", "n_item_tokens", "exact")])
        .select(
            F.col("key").alias(key), F.col("item").alias(item), "n_matched", "n_item_tokens", "exact"
        )
    )


def _value(token: Column) -> Column:
    return _fold(F.regexp_replace(token, r"(?<=\S)[.,;:!?)\"']+\z", ""))


def drop_leaked(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents without those whose text holds an item.

    Texts go by their digest here, so that rows without a key, or sharing one, are judged
    each by its own text.
    """
    digest = F.unhex(F.md5(F.col(text).cast("binary")))
    own = docs.select(digest.alias("_digest"), F.col(text).alias("_text"))
    leaks = find_leaks(own, benchmark, key="_digest", text="_text", **options)
    leak = fresh_name(docs.columns, "_leak")
    leaks = leaks.select(F.col("_digest").alias(leak)).distinct()
    leaks = Tables(docs.sparkSession).write(leaks, "leaks")
    return docs.join(leaks, digest == F.col(leak), "left_anti")
