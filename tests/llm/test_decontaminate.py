import random
import re

from biblink.llm import decontaminate as d

ITEM = "Maria bought 12 apples for 3 dollars each at the small market near the old river. How many dollars did Maria pay in total for the 12 apples?"
OTHER = "the quick brown fox jumps over the lazy dog while seven wise owls watch from a very tall oak tree"
FILL = "nothing of this sort was ever written here by anybody at all and so it goes on and on. "


def leaks(spark, docs, items=((1, ITEM), (2, OTHER), (3, None), (4, "")), **how):
    docs = spark.createDataFrame(docs, "doc_id long, text string, item_id string, hash int")
    out = d.leaks(docs, spark.createDataFrame(list(items), "item_id long, text string"), **how)
    return docs, {(r.doc_id, r.item_id): r.kind for r in out.collect()}


def rows(*texts):
    return [(i, t, "clash", 0) for i, t in enumerate(texts)]


def test_verbatim_reparameterised_inconsistent_and_clean(spark):
    changed = ITEM.replace("12", "45").replace("bought", "bought").replace(" 3 ", " 7 ")
    crossed = ITEM.replace("12", "45", 1)  # 12 refilled by 45 in one place and 12 in the other
    docs, got = leaks(spark, rows(FILL + ITEM + " " + FILL, FILL + changed, FILL + crossed, FILL * 3, OTHER.upper(), None, "", FILL + ITEM))
    assert got[0, 1] == "verbatim" and got[7, 1] == "verbatim"
    assert got[1, 1] == "reparameterised"
    assert got[2, 1] == "reparameterised"  # over 13 words up to the slot that contradicts the first
    assert got[4, 2] == "verbatim"
    assert {k[0] for k in got} == {0, 1, 2, 4, 7}
    kept = d.remove_leaking(docs, spark.createDataFrame([(1, ITEM), (2, OTHER)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5, 6]


def test_names_are_slots(spark):
    item = "yesterday morning the farmer asked Robert whether the new barn that Robert built last summer would hold enough hay for every cow"
    _, got = leaks(spark, rows(FILL + item.replace("Robert", "Susan"), FILL + item.replace("Robert", "Susan", 1)), items=[(9, item)])
    assert got == {(0, 9): "reparameterised", (1, 9): "verbatim"}  # 16 words from "whether" on


def test_broadcast_and_shuffle_agree_and_repeats_stay(spark):
    text = FILL + ITEM + FILL + ITEM
    a = leaks(spark, [(5, text, "", 0), (5, text, "", 0), (None, text, "", 0)])[1]
    b = leaks(spark, [(5, text, "", 0), (5, text, "", 0), (None, text, "", 0)], broadcast_rows=0)[1]
    assert a == b == {(5, 1): "verbatim", (None, 1): "verbatim"}


def test_short_items_and_empty_tables(spark):
    short = "nine brave bears ate honey"
    assert leaks(spark, rows("we saw " + short + " today", "nine bears"), items=[(1, short)])[1] == {(0, 1): "verbatim"}
    assert leaks(spark, [], items=[(1, short)])[1] == {}
    assert leaks(spark, rows(FILL), items=[])[1] == {}
    docs = spark.createDataFrame(rows(FILL, None), "doc_id long, text string, a string, b int")
    assert d.remove_leaking(docs, spark.createDataFrame([], "item_id long, text string")).count() == 2


def test_words_stay_aligned(spark):
    from pyspark.sql import functions as F

    texts = [ITEM, "a | b -- c {d} e} {n} 3.5kg 7 km/h (Anna's) Mr. Old-Smith 1st, ..., x", "", "Ünïcode Žena šla 3 m."]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(d.plain_words(F.col("t")).alias("raw"))
    for r in df.select("raw", d.template_words(F.col("raw")).alias("template")).collect():
        assert len(r.raw) == len(r.template), (r.raw, r.template)


#: Under 5 of any 8 words are no placeholders.
DENSE = "12 kg 7 cm 95 mi 1804 31 may 1804 14 oz 66 lb 203 km 8 ft 451 mm 1999 2001 17 g"


def test_verbatim_copies_of_dense_items_are_found(spark):
    other = DENSE.replace("1804", "1805").replace("95", "96").replace("203", "204").replace("14", "15").replace("451", "452")
    titled = "Anna Berg, Carl Dahl, Emil Falk, Greta Holm, Ida Juhl, Karl Lund, Maja Nord, Olof Palm"
    docs = rows(FILL + DENSE + " " + FILL, FILL + other, FILL + "we met " + titled + " there", FILL + titled.lower() + " " + FILL, FILL)
    for how in ({}, {"broadcast_rows": 0}):
        got = leaks(spark, docs, items=[(1, DENSE), (2, titled)], **how)[1]
        assert {k for k in got} == {(0, 1), (2, 2), (3, 2)} and set(got.values()) == {"verbatim"}


def test_case_of_a_copy_does_not_matter(spark):
    lower = "yesterday morning the old farmer asked whether the new barn built last summer would hold enough hay for every cow"
    named = "We know that Robert Smith asked Susan Jones whether Peter Brown would visit Paris with Maria and Carla before Easter Sunday"
    docs = rows(FILL + lower.title(), FILL + named.lower(), FILL + named.upper(), FILL + named, FILL)
    got = leaks(spark, docs, items=[(1, lower), (2, named)])[1]
    assert got == {(0, 1): "verbatim", (1, 2): "verbatim", (2, 2): "verbatim", (3, 2): "verbatim"}


def test_plain_windows_take_nothing_from_what_templates_find(spark):
    # only plain windows reach the dense head; its 7 stays, the 7 of the rest is refilled
    item = "7 cm 95 mi 8 ft 66 lb the farmer took apples from the small market near the old river and then paid 7 dollars for the long walk home that night"
    assert leaks(spark, rows(FILL + item.replace("paid 7", "paid 9")), items=[(1, item)])[1] == {(0, 1): "reparameterised"}


def test_plain_words_stay_aligned(spark):
    from pyspark.sql import functions as F

    texts = [ITEM, "a | b -- c {d} e} {n} 3.5kg 7 km/h (Anna's) Mr. Old-Smith 1st, ..., x", "", "Ünïcode Žena šla 3 m. ² İ ① x\x1fy"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(d.plain_words(F.col("t")).alias("raw"))
    for r in df.select("raw", d.lower_words(F.col("raw")).alias("plain"), d.template_words(F.col("raw")).alias("template")).collect():
        assert len(r.raw) == len(r.plain) == len(r.template), (r.raw, r.plain)
        assert not {*d.PLACEHOLDERS} & {*r.plain}


def twin(doc, item, window=8, min_literals=5, min_words=13, min_share=0.8):
    """Every window, diagonal and stretch of words by itself; words are letters and digits only."""
    def template(words):
        out = []
        for k, w in enumerate(words):
            if re.fullmatch(r"[0-9]+", w) or w.lower() in d.NUMBER_WORDS:
                out.append(d.NUMBER)
            elif w.lower() in d.UNITS and out and out[-1] == d.NUMBER:
                out.append(d.UNIT)
            elif k and re.fullmatch(r"[A-Z][a-z]+", w):
                out.append(d.NAME)
            else:
                out.append(w.lower())
        return out

    x, y = (doc or "").split(), (item or "").split()
    tx, ty, lx, ly = template(x), template(y), [w.lower() for w in x], [w.lower() for w in y]
    size = min(window, len(y))
    asked = min(min_literals, -(-size * min_literals // window))
    diagonals = {}
    for i in range(len(x) - size + 1):
        for j in range(len(y) - size + 1):
            literal = sum(w not in d.PLACEHOLDERS for w in ty[j : j + size])
            by_template = tx[i : i + size] == ty[j : j + size] and literal >= asked
            # plain windows of a document count where it has a placeholder
            by_plain = lx[i : i + size] == ly[j : j + size]
            if size and (by_template or by_plain):
                diagonals.setdefault(i - j, []).append((j, by_template))
    best = 0
    for shift, met in diagonals.items():
        for part in ([j for j, _ in met], [j for j, t in met if t]):
            if not part:
                continue
            lo, hi = min(part), max(part) + size
            for a in range(lo, hi):
                fills, n = {}, 0
                for k in range(a, hi):
                    if ty[k] in d.PLACEHOLDERS:
                        if fills.setdefault((ty[k], ly[k]), lx[k + shift]) != lx[k + shift]:
                            break
                        n += 1
                    else:
                        n += ly[k] == lx[k + shift]
                    best = max(best, n)
    return best if best and (best >= min_words or best >= min_share * len(y)) else 0


def test_equal_to_every_window_and_stretch(spark):
    rng = random.Random(7)
    vocabulary = ["apple", "pear", "went", "to", "Maria", "Robert", "Paris", "12", "7", "kg", "seven", "the", "old"]
    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [words(rng.choice([3, 6, 9, 14, 20, 30])) for _ in range(25)]
    docs = []
    for _ in range(120):
        text = words(rng.randrange(12))
        for item in rng.sample(items, 2):
            copy = list(item)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                k = rng.randrange(len(copy))
                copy[k] = rng.choice(vocabulary)
            text += copy[rng.choice([0, 0, 2]) :] + words(rng.randrange(5))
        docs.append(" ".join(text))
    rows_ = [(i, t) for i, t in enumerate(docs)]
    keyed = [(k, " ".join(t)) for k, t in enumerate(items)]
    out = d.leaks(spark.createDataFrame(rows_, "doc_id long, text string"), spark.createDataFrame(keyed, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.n_words for r in out}
    want = {(i, k): n for i, t in rows_ for k, item in keyed if (n := twin(t, item))}
    assert len(want) > 120
    assert got == want


def test_bare_words_equal_the_pattern(spark):
    from pyspark.sql import functions as F

    texts = ["".join(map(chr, range(32, 128))), "".join(map(chr, range(1, 32))), "a\x00b", "é—x … „y“ ² ① İ e\u0301 深層！", "{n} a{b}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = r"[\x00-\x1F!-/:-@\[-`|~\x7F]+|[^\x00-\x7F\p{L}\p{M}\p{N}]+"
    for r in df.select(d._bare(F.col("t")).alias("a"), F.regexp_replace("t", pattern, "").alias("b")).collect():
        assert r.a == r.b
