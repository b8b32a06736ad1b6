r"""Benchmark decontamination by template canonicalisation, in built-ins only.

Words become template words: numbers turn into ``{n}``, units after a number
into ``{u}``, capitalised words inside a sentence into ``{x}``; everything else
is lower-cased and stripped of punctuation.  Windows of template words are
hashed and joined with the windows of the benchmark.  Matches on one diagonal
(document position minus item position) are then checked word by word: the
slots of an item must be refilled consistently, that is, one item value always
by the same document value.  Where two slots contradict each other the diagonal
is split: every longest stretch without a contradiction is judged on its own.
So a question with other numbers or names is caught, a chance meeting of
placeholders is not, and one slot changed in a copy does not hide the rest.

A template window must hold ``min_literals`` words that are not placeholders (a shorter
one as large a share), and a document leaks an item when ``min_words`` words or ``min_share``
of the item agree in a consistent stretch of a diagonal.  Items shorter than a window
are matched as one window of their own length.

Beside them the windows of the plain words, lower-cased and without punctuation
but with no placeholders, take part in the same join, and none of them is left
out.  So a copy word for word is found whatever its share of numbers, units and
names, and whatever the case on either side.

The benchmark windows are counted first: up to ``broadcast_rows`` of them are
broadcast, more are joined by a shuffle of the document windows' hashes.

Nulls: null texts have no words; a null id is carried like any other.  Items
without words match nothing.  Equal items are all reported.  Repeated rows of
a document are told apart by their text and judged alike.  A very long text is one
row and one array of hashes in its task; its windows are rows of their own.  Ties
between stretches go to the first position.  Empty tables give empty results.
Other columns of the inputs are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, written

#: Unit words, fixed values; they count as units only after a number.
UNITS = (
    "mm cm m km in ft yd mi mile miles inch inches foot feet meter meters metre metres kilometer kilometers "
    "mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "c f k degree degrees percent dollar dollars euro euros cent cents usd eur kmh mph km/h m/s"
).split()
#: Number words, fixed values.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()

NUMBER, UNIT, NAME = "{n}", "{u}", "{x}"
PLACEHOLDERS = (NUMBER, UNIT, NAME)


def either(words: list[str]) -> str:
    """A pattern for any of the words, factored by common prefixes so that few
    alternatives are tried at a place (longer words first)."""
    heads: dict[str, list[str]] = {}
    for w in words:
        heads.setdefault(w[:1], []).append(w[1:])
    last = "?" if heads.pop("", None) else ""
    parts = [re.escape(h) + either(sorted(set(rest))) for h, rest in sorted(heads.items())]
    return f"(?:{'|'.join(parts)}){last}" if parts else ""


def plain_words(text: Column) -> Column:
    """Words that hold a letter or digit, as written."""
    text = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x09-\x0D]", " ")
    return F.filter(F.split(text, " "), lambda w: w.rlike(r"[0-9A-Za-z]|[\p{L}\p{N}]"))


def template_words(raw: Column) -> Column:
    """The template word of every word of an array, in place.

    Works on the joined text: a word never holds a space, so words stay aligned.
    Every pattern starts with a space or a character range, which the regex
    engine rejects quickly elsewhere.
    """
    t = F.concat(F.lit(" "), F.array_join(raw, " "), F.lit(" "))
    t = F.replace(F.replace(t, F.lit("{"), F.lit("")), F.lit("}"), F.lit(""))
    # names: capitalised, not all capitals, and the word before does not end a sentence.  The
    # first test of each pattern only refuses early what the rest would refuse
    t = F.regexp_replace(t, r" (?![a-z])(?<=[^\s.!?:] )[^\p{L}\p{N}\s]*\p{Lu}[\p{Ll}\p{M}]+(?:['’-]\p{L}+)*[^\p{L}\p{N}\s]*(?= )", " " + NAME)
    t = F.lower(t)
    others = "".join(c for c in "abcdefghijklmnopqrstuvwxyz" if c not in {w[0] for w in NUMBER_WORDS})
    t = F.regexp_replace(t, rf" (?![{others}])[^\p{{L}}\p{{N}}\s]*(?:\p{{N}}[\p{{N}}.,:/]*(?:st|nd|rd|th)?|{either(NUMBER_WORDS)})[^\p{{L}}\p{{N}}\s]*(?= )", " " + NUMBER)
    t = F.regexp_replace(t, rf" \{{n\}} [^\p{{L}}\p{{N}}\s]*{either(UNITS)}[^\p{{L}}\p{{N}}\s]*(?= )", f" {NUMBER} {UNIT}")
    return F.filter(F.split(_bare(t), " "), lambda w: w != "")


def lower_word(raw: Column) -> Column:
    """The plain word of one raw word: lower-cased, no placeholder."""
    return _bare(F.translate(F.lower(raw), "{}", ""))


def lower_words(raw: Column) -> Column:
    """The plain word of every word of an array, in place."""
    return F.filter(F.split(lower_word(F.array_join(raw, " ")), " "), lambda w: w != "")


#: A class of ASCII control characters and punctuation but braces, which placeholders have.
#: Each is named: single characters are one table for the regex engine, ranges are tests.
_MARKS = "".join(f"\\x{c:02x}" for c in [*range(32), *range(33, 48), *range(58, 65), *range(91, 97), 124, 126, 127])


def _bare(t: Column) -> Column:
    """A text without ASCII punctuation and without what else is no letter, mark, digit or space."""
    # only a text with other than ASCII characters can hold any of the rest
    rest = lambda t: F.when(F.octet_length(t) == F.length(t), t).otherwise(F.regexp_replace(t, r"[^\x00-\x7F\p{L}\p{M}\p{N}]+", ""))
    return let(F.regexp_replace(t, rf"[{_MARKS}]+", ""), rest)


def run_hashes(hashes: Column, size: int) -> Column:
    """Hash of every ``size`` consecutive hashes of an array with at least so many,
    built by doubling: log2(size) steps per element instead of ``size``."""
    if size == 1:
        return hashes
    back = size // 2 if size % 2 == 0 else 1

    def join(a: Column) -> Column:
        n = F.size(hashes) - (size - 1)
        return F.zip_with(F.slice(a, 1, n), F.slice(hashes if size % 2 else a, size - back + 1, n), lambda x, y: F.xxhash64(x, y))

    return let(run_hashes(hashes, size - back), join)


def window_hashes(hashes: Column, size: int) -> Column:
    """The hash of the window of ``size`` words at every position; none in a shorter text."""
    return F.when(F.size(hashes) >= size, run_hashes(hashes, size)).otherwise(F.array().cast("array<bigint>"))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(template: Column, size: int) -> Column:
    """``array<struct<pos, hash>>`` of all windows of ``size`` words."""
    def of(hashes: Column) -> Column:
        return F.transform(window_hashes(hashes, size), lambda v, i: F.struct(i.alias("pos"), v.alias("hash")))

    return let(word_hashes(template), of)


def item_windows(template: Column, size: int, min_literals: int, full: int) -> Column:
    """The same, without windows that hold too few words that are no placeholders:
    ``min_literals`` of ``full`` words are asked, as large a share of fewer.  A
    document window that matches one of them is the same template, so documents
    need no such check."""
    asked = min(min_literals, -(-size * min_literals // full))

    def literals(w: Column) -> Column:
        return F.size(F.filter(F.slice(template, w["pos"] + 1, size), lambda x: ~x.isin(*PLACEHOLDERS)))

    return F.filter(windows(template, size), lambda w: literals(w) >= asked)


def document_windows(raw: Column, sizes: list[int]) -> Column:
    """``struct<n, hashes>`` per size: the hashes of all template windows, ``n`` of them, then in
    the same order those of the plain windows, null where a window holds no placeholder (it is
    the template window there).  Plain words are made and hashed only at the placeholders."""

    def of(t: Column) -> Column:
        marked = F.zip_with(t, raw, lambda x, r: F.when(x.isin(*PLACEHOLDERS), F.xxhash64(lower_word(r))))
        return let(F.struct(word_hashes(t).alias("t"), marked.alias("m")), both)

    def both(h: Column) -> Column:
        plain = F.zip_with(h["m"], h["t"], lambda m, x: F.coalesce(m, x))
        return let(F.struct(h["t"].alias("t"), F.when(F.exists(h["m"], lambda m: m.isNotNull()), plain).alias("p")), lambda x: F.array(*(sized(x, n) for n in sizes)))

    def sized(h: Column, size: int) -> Column:
        def joined(w: Column) -> Column:
            others = F.zip_with(w["p"], w["t"], lambda p, t: F.when(p != t, p))
            return F.struct(F.size(w["t"]).alias("n"), F.concat(w["t"], F.coalesce(others, F.array().cast("array<bigint>"))).alias("hashes"))

        return let(F.struct(window_hashes(h["t"], size).alias("t"), F.when(h["p"].isNotNull(), window_hashes(h["p"], size)).alias("p")), joined)

    return let(template_words(raw), of)


def consistent_stretches(pairs: Column) -> Column:
    """``array<struct<first, last>>``: the longest stretches (last excluded) of word pairs
    ``template, item, doc`` in which no item value of a slot has two document values."""
    slots = F.filter(F.transform(pairs, lambda p, i: F.when(p["template"].isin(*PLACEHOLDERS), F.struct(i.alias("at"), p["template"].alias("t"), p["item"].alias("item"), p["doc"].alias("doc")))), lambda x: x.isNotNull())

    def of(slots: Column) -> Column:
        def against(s: Column) -> Column:  # the last slot before that contradicts this one
            other = F.filter(slots, lambda o: (o["at"] < s["at"]) & (o["t"] == s["t"]) & (o["item"] == s["item"]) & (o["doc"] != s["doc"]))
            return F.struct(s["at"].alias("at"), F.array_max(F.transform(other, lambda o: o["at"])).alias("other"))

        return let(F.filter(F.transform(slots, against), lambda c: c["other"].isNotNull()), ranges)

    def ranges(clashes: Column) -> Column:
        starts = F.array_distinct(F.concat(F.array(F.lit(0)), F.transform(clashes, lambda c: c["other"] + 1)))

        def upto(first: Column) -> Column:
            ends = F.transform(F.filter(clashes, lambda c: c["other"] >= first), lambda c: c["at"])
            return F.struct(first.alias("first"), F.coalesce(F.array_min(ends), F.size(pairs)).alias("last"))

        return F.transform(starts, upto)

    return let(slots, of)


def leaks(
    docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 8, min_literals: int = 5, min_words: int = 13, min_share: float = 0.8, broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """One row per leaked (document, item): ``doc_id, item_id, position, n_words,
    item_words, n_slots, kind`` of the best diagonal; ``kind`` is ``verbatim`` or
    ``reparameterised``.  ``text_hash`` tells repeated ids with other texts apart."""
    bench = items.select(F.col(item_id).alias("item_id"), plain_words(F.col(item_text)).alias("raw")).where("size(raw) > 0")
    bench = bench.select("item_id", "raw", template_words(F.col("raw")).alias("template"), lower_words(F.col("raw")).alias("plain"))
    bench = bench.withColumn("size", F.least(F.lit(window), F.size("template")))
    sizes = sorted(r[0] for r in bench.select("size").distinct().collect()) or [window]  # at most `window` numbers
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")

    def keys_of(kind: str, of) -> DataFrame:
        arrays = [F.when(F.col("size") == n, of(n)).otherwise(none) for n in sizes]
        return bench.select("item_id", "size", F.explode(F.concat(*arrays)).alias("w")).select("item_id", "size", F.col("w.pos").alias("item_pos"), F.col("w.hash").alias("hash"), F.lit(kind).alias("kind"))

    keys = keys_of("template", lambda n: item_windows(F.col("template"), n, min_literals, window)).union(keys_of("plain", lambda n: windows(F.col("plain"), n)))
    keys = keys.groupBy("item_id", "size", "item_pos", "hash").agg(F.max(F.col("kind") == "template").alias("by_template"))
    small = keys.count() <= broadcast_rows

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).cast("string").alias("text"))
    found = narrow.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(let(plain_words(F.col("text")), lambda raw: document_windows(raw, sizes))).alias("w"))
    found = found.select("doc_id", "text_hash", F.col("w.n").alias("n"), F.posexplode("w.hashes").alias("pos", "hash"))
    plain = F.col("pos") >= F.col("n")
    found = found.select("doc_id", "text_hash", F.when(plain, F.col("pos") - F.col("n")).otherwise(F.col("pos")).alias("pos"), "hash", plain.alias("plain"))
    met = found.join(F.broadcast(keys) if small else keys, "hash")
    # the stretch of a diagonal that windows matched by template span, and the one of all
    # windows: plain windows add to what templates find and take nothing from it.  Read
    # twice below, so written once: the pass over all texts runs once
    by_template = F.col("by_template") & ~F.col("plain")
    end = F.col("item_pos") + F.col("size")
    diagonals = met.groupBy("doc_id", "text_hash", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.struct(F.min("item_pos").alias("lo"), F.max(end).alias("hi")).alias("all"),
        F.struct(F.min(F.when(by_template, F.col("item_pos"))).alias("lo"), F.max(F.when(by_template, end)).alias("hi")).alias("matched"),
    )
    stretches = F.array_distinct(F.filter(F.array("all", "matched"), lambda x: x["lo"].isNotNull()))
    diagonals = diagonals.select("doc_id", "text_hash", "item_id", "shift", F.explode(stretches).alias("x")).select("doc_id", "text_hash", "item_id", "shift", "x.lo", "x.hi")
    diagonals = written(diagonals, "diagonals")
    # one copy of each text that met an item, cut to its words
    wanted = diagonals.select("doc_id", "text_hash").distinct()
    texts = narrow.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    cut = texts.join(wanted.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("th")), F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("th")), "left_semi")
    cut = cut.groupBy("doc_id", "text_hash").agg(F.min("text").alias("text")).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("th"), plain_words(F.col("text")).alias("doc_raw"))
    sides = (
        diagonals.join(cut, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("th")))
        .join(bench.select(F.col("item_id").alias("i"), "raw", "template"), F.col("item_id").eqNullSafe(F.col("i")))
        .select("doc_id", "text_hash", "item_id", "shift", "lo", "hi", F.size("template").alias("item_words"),
                F.slice("template", F.col("lo") + 1, F.col("hi") - F.col("lo")).alias("template"),
                F.slice("raw", F.col("lo") + 1, F.col("hi") - F.col("lo")).alias("raw"),
                F.slice("doc_raw", F.col("lo") + F.col("shift") + 1, F.col("hi") - F.col("lo")).alias("doc_raw"))
    )
    bare = lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}]+", "")
    paired = F.arrays_zip("template", F.transform("raw", bare).alias("item"), F.transform("doc_raw", bare).alias("doc"))
    checked = sides.select("doc_id", "text_hash", "item_id", "shift", "lo", "hi", "item_words", F.explode(F.array(paired)).alias("pairs"))
    split = checked.select("doc_id", "text_hash", "item_id", "shift", "lo", "item_words", "pairs", F.explode(consistent_stretches(F.col("pairs"))).alias("s"))
    part = split.select("doc_id", "text_hash", "item_id", "item_words", (F.col("shift") + F.col("lo") + F.col("s.first")).alias("position"),
                        F.explode(F.array(F.slice("pairs", F.col("s.first") + 1, F.col("s.last") - F.col("s.first")))).alias("pairs"))
    same_words = F.size(F.filter("pairs", lambda p: p["template"].isin(*PLACEHOLDERS) | (p["item"] == p["doc"])))
    changed = F.exists("pairs", lambda p: ~p["item"].eqNullSafe(p["doc"]))
    judged = part.select(
        "doc_id", "text_hash", "item_id", "item_words", "position", same_words.alias("n_words"), F.size(F.filter("pairs", lambda p: p["template"].isin(*PLACEHOLDERS))).alias("n_slots"),
        F.when(changed, "reparameterised").otherwise("verbatim").alias("kind"),
    ).where((F.col("n_words") >= min_words) | (F.col("n_words") >= min_share * F.col("item_words")))
    best = F.max_by(F.struct("position", "n_words", "item_words", "n_slots", "kind"), F.struct("n_words", -F.col("position")))
    return judged.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*", "text_hash")


def remove_leaking(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", doc_text: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that leak an item; columns and repeated rows stay."""
    found = leaks(docs, items, doc_id=doc_id, doc_text=doc_text, **how)
    d, th = fresh(docs.columns, "__leak_doc", "__leak_text")
    found = found.select(F.col("doc_id").alias(d), F.col("text_hash").alias(th)).distinct()
    return docs.join(found, docs[doc_id].eqNullSafe(found[d]) & F.xxhash64(docs[doc_text].cast("string")).eqNullSafe(found[th]), "left_anti")
