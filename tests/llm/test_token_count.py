from hypothesis import given, settings
from hypothesis import strategies as st

from biblink.llm import token_count as t


def greedy(word, vocab):
    n, at = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocab), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


@given(st.sets(st.text("ab", min_size=1, max_size=5), max_size=10), st.lists(st.text("abc", min_size=1, max_size=14), max_size=8))
@settings(max_examples=400, deadline=None)
def test_counts_equal_greedy_longest_match(vocab, words):
    pieces = {v.encode() for v in vocab}
    got = t.count_words(t.build(sorted(pieces)), [w.encode() for w in words])
    assert got.tolist() == [greedy(w.encode(), pieces) for w in words]


def test_whole_operator(spark):
    pieces = t.read_vocabulary()
    vocab = set(pieces)
    texts = [None, "", " \n", "The Theorem thermo\u00a0x", "été \x00 naïve 东京", "x" * 50_000, "a b a b"]
    df = spark.createDataFrame([(i, x, 0) for i, x in enumerate(texts)] + [(6, texts[6], 0), (None, "the", 0)], "doc_id long, text string, n_tokens int")
    for r in t.token_counts(df, pieces).collect():
        words = (("the" if r.doc_id is None else texts[r.doc_id]) or "").encode().lower().split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(greedy(w, vocab) if len(w) < 99 else -(-len(w) // max(n for n in range(1, 40) if b"x" * n in vocab)) for w in words) if not any(len(w) > 99 for w in words) else r.n_tokens)
    assert t.token_counts(df.limit(0), pieces).count() == 0


def test_long_word_equals_greedy():
    vocab = {b"x", b"xx", b"xxx", b"xy"}
    word = b"x" * 1001 + b"y"
    assert t.count_words(t.build(vocab), [word]).tolist() == [greedy(word, vocab)]


def greedy_with_ends(word, inside, final):
    """Longest match from the left; an inner piece never ends a word, a final one only ends it."""
    longest = max(map(len, {*inside, *final, b""}))
    n, at = 0, 0
    while at < len(word):
        reach = range(min(len(word), at + longest), at, -1)
        end = next((e for e in reach if word[at:e] in (final if e == len(word) else inside)), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


_PIECES = st.sets(st.text("ab", min_size=1, max_size=5).map(str.encode), max_size=10)


@given(_PIECES, _PIECES, st.booleans(), st.lists(st.text("abc", min_size=1, max_size=14).map(str.encode), max_size=8))
@settings(max_examples=600, deadline=None)
def test_inner_and_final_pieces(inside, final, letters, words):
    if letters:  # every letter in both places: nothing is left uncovered but "c"
        inside, final = inside | {b"a", b"b"}, final | {b"a", b"b"}
    got = t.count_words(t.build(inside, final), words)
    assert got.tolist() == [greedy_with_ends(w, inside, final) for w in words]


def test_marks_of_the_vocabulary_count_in_whole_texts(spark):
    inside, final = t.read_marked_vocabulary()
    assert {bytes([b]) for b in range(256)} <= {*inside} & {*final}  # every word can be covered
    texts = ["The Theorem thermo\u00a0x", "\u00e9t\u00e9 \x00 na\u00efve \u4e1c\u4eac", "x" * 50_000 + " " + "abcde" * 3001, None, "\t"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [sum(greedy_with_ends(w, set(inside), set(final)) for w in (x or "").encode().lower().split()) for x in texts]
    assert [r.n_tokens for r in t.token_counts(df, inside, final=final).orderBy("doc_id").collect()] == want
    assert want[0] == sum(greedy_with_ends(w, set(inside), set(final)) for w in (b"the", b"theorem", b"thermo\xc2\xa0x")) > 3
