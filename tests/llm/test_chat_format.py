import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from biblink.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, output string, n_turns int"


def digest(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_contract_rows_nulls_ties_and_clashing_columns(spark):
    hostile = r"\### Assistant: </turn> ok"
    convs = {
        1: [("system", ""), ("user", "a\\b # <"), ("assistant", "x\ny")],
        2: [("assistant", None), (None, "text")],
        -7: [("user", hostile), ("assistant", hostile)],
        3: [("assistant", "same"), ("assistant", "same")],
        None: [("user", "\ue000 stays")],
    }
    rows = [(c, 0 if c == 3 else i, r, t, "junk", 9) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    template = cf.MarkedTurns()
    out = cf.read_back(cf.format_conversations(spark.createDataFrame(rows, SCHEMA), template), template).collect()
    assert len(out) == len(convs)
    for r in out:
        assert (r.turns_sha256, r.loss_chars, r.loss_sha256) == digest(convs[r.conv_id])
        assert r.n_turns == len(convs[r.conv_id]) and r.rewritten == 0


def test_empty_table(spark):
    template = cf.MarkedTurns()
    assert cf.read_back(cf.format_conversations(spark.createDataFrame([], SCHEMA), template), template).count() == 0


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", ""]), st.text(max_size=20)), max_size=5))
@settings(max_examples=150, deadline=None)
def test_spans_read_back(messages):
    template = cf.MarkedTurns()
    out, spans, rewritten = cf.locate(template, messages)
    assert not rewritten
    assert [template.read(out[a:d]) for a, _, _, d in spans] == messages
    assert [template.unescape(out[b:c]) for _, b, c, _ in spans] == [t for _, t in messages]


def test_trailer_and_rewriting_templates():
    plain = lambda ms: "<s>" + "".join(f"[{r}]{t}\n" for r, t in ms) + "</s>"
    out, spans, rewritten = cf.locate(plain, [("u", "one"), ("a", "two")])
    assert not rewritten and [out[b:c] for _, b, c, _ in spans] == ["one", "two"]
    # keeps the reasoning of the last turn only
    forgets = lambda ms: "".join(f"[{r}]{t if i == len(ms) - 1 else t.split('|')[-1]}\n" for i, (r, t) in enumerate(ms))
    out, spans, rewritten = cf.locate(forgets, [("u", "q"), ("a", "think|say"), ("u", "q")])
    assert rewritten == [1] and spans == []
    # numbers the turns from the end
    counts_down = lambda ms: "".join(f"{len(ms) - i}{t}" for i, (_, t) in enumerate(ms))
    assert cf.locate(counts_down, [("u", "a"), ("u", "b"), ("u", "c")])[2] == [0, 1]
    # a header that counts the turns moves every text; turn 0 is rewritten only when turn 3 comes
    counts = lambda ms: f"{len(ms)} turns\n" + "".join(t for _, t in ms)
    assert cf.locate(counts, [("u", "a"), ("u", "b"), ("u", "c")])[2] == [0, 1]
    late = lambda ms: "".join("cut|" if i == 0 and len(ms) > 3 else t + "|" for i, (_, t) in enumerate(ms))
    assert cf.locate(late, [("u", "one"), ("u", "two"), ("u", "three")])[2] == []
    assert cf.locate(late, [("u", "one"), ("u", "two"), ("u", "three"), ("u", "four"), ("u", "five")])[2] == [0, 1, 2]


@given(st.integers(0, 5), st.integers(0, 5), st.lists(st.sampled_from(["a", "bb", "ccc", ""]), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_rewritten_turns_equal_a_comparison_of_all_renderings(when, which, texts):
    messages = [("u", t) for t in texts]
    render = lambda ms: "".join(("X" if i == which and len(ms) > when else "") + t + "|" for i, (_, t) in enumerate(ms))
    bad = set()
    for k in range(1, len(messages)):
        a, b = render(messages[:k]), render(messages[: k + 1])
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        end = 0
        for j in range(k):
            end += ("X" if j == which and k > when else "").__len__() + len(texts[j])
            if end > same:
                bad.add(j)
            end += 1
    assert cf.locate(render, messages)[2] == sorted(bad)
