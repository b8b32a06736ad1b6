r"""Chat formatting by incremental black-box rendering.

A chat template is any function from a list of ``(role, text)`` turns to one
string; nothing of its inside is used.  ``locate`` renders the successive
prefixes of a conversation and compares consecutive outputs:

* output ``k`` and output ``k+1`` agree up to where turn ``k+1`` begins, so the
  common prefix ends the span of turn ``k``;
* rendering prefix ``k`` once more with a probe character as its last text
  shows where the text of turn ``k`` sits inside its span (header and footer
  are what stands before and after the probe);
* if a later output disagrees with an earlier one before the end of a text
  already written, the template rewrites history.  Such conversations get the
  numbers of the rewritten turns and no spans: offsets into the earlier output
  mean nothing in the final one.

The work is one rendering and one probe per turn, as the method asks; memory
is bounded by one conversation.

Nulls and ties: a null role or text is the empty string; rows without a
conversation id form one conversation with a null id; rows are ordered by
turn (null first), then role, then text, and repeated rows stay.  An empty
table gives an empty result.  Other columns of the input are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Messages = list[tuple[str, str]]
Render = Callable[[Messages], str]

#: A private-use character that stands for "some text" when a turn is probed.
PROBE = "\ue000"

FORMATTED = (
    "conv_id {id}, n_turns bigint, output string, rewritten array<int>, "
    "turns array<struct<start:int,text_start:int,text_end:int,end:int>>"
)


class MarkedTurns:
    r"""``### role: text</turn>`` per turn, every control character of a text escaped.

    ``\``, ``#`` and ``<`` inside a text (and ``:`` inside a role) get a
    backslash, so an unescaped ``###`` or ``</turn>`` is always a mark, and
    removing the backslashes gives the text back.
    """

    turn = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.S)

    def __call__(self, messages: Messages) -> str:
        return "".join(f"### {re.sub(r'([\\#<:])', r'\\\1', r)}: {re.sub(r'([\\#<])', r'\\\1', t)}</turn>\n" for r, t in messages)

    @staticmethod
    def unescape(piece: str) -> str:
        return re.sub(r"\\(.)", r"\1", piece, flags=re.S)

    def read(self, piece: str) -> tuple[str, str]:
        """Role and text of one rendered turn."""
        m = self.turn.fullmatch(piece)
        if m is None:
            raise ValueError("not a turn of this template")
        return self.unescape(m[1]), self.unescape(m[2])


def common_prefix(a: str, b: str) -> int:
    """Length of the longest common prefix (binary search on slices)."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return lo


def locate(render: Render, messages: Messages) -> tuple[str, list[tuple[int, int, int, int]], list[int]]:
    """Output, (start, text start, text end, end) of each turn, numbers of rewritten turns: those
    whose text holds, or comes after, the first place where a later turn changes the output."""
    spans: list[tuple[int, int, int, int]] = []
    first = len(messages)  # turns from here on are rewritten, up to the last that has a successor
    last, before, start = 0, "", 0
    for k in range(len(messages)):
        out = render(messages[: k + 1])
        if k:
            same = common_prefix(before, out)
            # texts end in order: go back over those that end behind the first difference
            j = min(k, first)
            while j and spans[j - 1][2] > same:
                j -= 1
            if j < min(k, first) or (first < k and spans[k - 1][2] > same):
                first, last = j, k
            spans[-1] = (*spans[-1][:3], same)
            start = same
        probe = render([*messages[:k], (messages[k][0], PROBE)])
        at = probe.rfind(PROBE)
        if at < start:  # the template shows no text for this turn
            text_start = text_end = len(out)
        else:
            text_start, text_end = at, len(out) - (len(probe) - at - 1)
        spans.append((start, text_start, text_end, len(out)))
        before = out
    rewritten = list(range(first, last))
    return before, [] if rewritten else spans, rewritten


def format_conversations(
    df: DataFrame, render: Render, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: output, the spans of its turns, rewritten turns."""
    grouped = (
        df.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("row"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("row")).alias("rows"))
        .select("conv_id", F.col("rows.role").alias("roles"), F.col("rows.text").alias("texts"))
    )
    schema = FORMATTED.format(id=df.schema[conv].dataType.simpleString())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for cid, roles, texts in zip(batch["conv_id"], batch["roles"], batch["texts"], strict=True):
                out, spans, rewritten = locate(render, list(zip(roles, texts, strict=True)))
                keys = ("start", "text_start", "text_end", "end")
                rows.append((None if pd.isna(cid) else cid, len(roles), out, rewritten, [dict(zip(keys, s, strict=True)) for s in spans]))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "output", "rewritten", "turns"]).astype({"conv_id": object})

    return grouped.mapInPandas(run, schema)


def read_back(formatted: DataFrame, template: MarkedTurns, trained: str = "assistant") -> DataFrame:
    """Digest of each conversation, computed from output and spans alone.

    The loss mask is the text span of every turn of role ``trained``.
    """
    import hashlib

    schema = formatted.select("conv_id").schema.simpleString()[len("struct<") : -1].replace("conv_id:", "conv_id ")
    schema += ", n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewritten int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for cid, n, out, rewritten, spans in batch[["conv_id", "n_turns", "output", "rewritten", "turns"]].itertuples(index=False):
                turns, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for s in spans:
                    role, text = template.read(out[s["start"] : s["end"]])
                    turns.update(f"{role}\n{text}\n".encode())
                    if role == trained:
                        masked = template.unescape(out[s["text_start"] : s["text_end"]])
                        chars += len(masked)
                        loss.update(masked.encode())
                rows.append((None if pd.isna(cid) else cid, n, turns.hexdigest(), chars, loss.hexdigest(), len(out), len(rewritten)))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten"]).astype({"conv_id": object})

    return formatted.mapInPandas(run, schema)
