"""Chat formatting with a template treated as a black box.

A template is any function of the turns that returns text. The formatter
renders successive prefixes of a conversation and compares neighbours: what a
turn appends is its span, and a prefix that is not kept shows a template that
rewrites history. Where the text of a turn starts inside its span is found by
rendering two probe texts and looking where the outputs part.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)
PROBES = ("a", "b")

FORMATTED = (
    "conv_id long, formatted string, n_turns long, rewrites_history boolean, "
    "turn_spans array<struct<start:int,end:int>>, loss_spans array<struct<start:int,end:int>>"
)
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "rewrites_history boolean"
)


def escape(text: str) -> str:
    """One more backslash inside every "<|", however many are there already."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(n|\\)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def marked_turns(turns: Sequence[Turn]) -> str:
    """The production template: a start mark with the role, the escaped text, an end mark."""
    return "".join(f"{START}{_role_out(role)}\n{escape(text)}{END}\n" for role, text in turns)


def parse(formatted: str) -> list[Turn]:
    """The turns back from the output of ``marked_turns``."""
    return [(_role_in(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _parting(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _text_span(template: Template, before: Sequence[Turn], turn: Turn, after: Sequence[Turn], whole: str) -> tuple[int, int]:
    """Where the text of one turn lies in the rendering of the whole.

    The probes are of equal length and differ, so their outputs part exactly
    where the text starts; what follows it has the same length in each.
    """
    probe = [template([*before, (turn[0], p), *after]) for p in PROBES]
    start = _parting(*probe)
    tail = len(probe[0]) - start - len(PROBES[0])
    return start, max(start, len(whole) - tail)


def format_turns(turns: Sequence[Turn], template: Template, learn: str = "assistant") -> dict:
    """The rendering, the span of each turn and of each learnt text, and whether history is rewritten.

    A template that rewrites history has no spans by prefix; its learnt texts
    are then located by probing the whole conversation.
    """
    spans, loss, before, rewrites = [], [], template([]), False
    for k in range(1, len(turns) + 1):
        now = template(turns[:k])
        rewrites = rewrites or not now.startswith(before)
        spans.append((len(before), len(now)))
        if turns[k - 1][0] == learn and not rewrites:
            loss.append(_text_span(template, turns[: k - 1], turns[k - 1], (), now))
        before = now
    if rewrites:
        spans = []
        places = [k for k, (role, _) in enumerate(turns) if role == learn]
        loss = [_text_span(template, turns[:k], turns[k], turns[k + 1 :], before) for k in places]
    return {"formatted": before, "n_turns": len(turns), "rewrites_history": rewrites, "turn_spans": spans, "loss_spans": loss}


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns by number, then role and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def format_chats(rows: DataFrame, template: Template = marked_turns, learn: str = "assistant") -> DataFrame:
    """Render every conversation; ``rows`` has conv_id, turn, role and text.

    Null roles and texts are empty, a null turn number comes first, rows with
    equal numbers follow each other by role and text, and repeated rows are
    repeated turns. Null ids form one conversation. Further columns are
    ignored; an empty table gives no rows. One conversation is one output row
    and so is held in one task; prefixes are rendered anew for every turn.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [format_turns([(t["role"], t["text"]) for t in turns], template, learn) for turns in batch["turns"]]
            out = pd.DataFrame(done, columns=["formatted", "n_turns", "rewrites_history", "turn_spans", "loss_spans"])
            for c in ("turn_spans", "loss_spans"):
                out[c] = [[{"start": s, "end": e} for s, e in spans] for spans in out[c]]
            out.insert(0, "conv_id", batch["conv_id"].array)
            yield out

    return conversations_of(rows).mapInPandas(run, FORMATTED)


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests read back from formatted conversations alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for conv, text, spans, rewrites in zip(
                batch["conv_id"], batch["formatted"], batch["loss_spans"], batch["rewrites_history"], strict=True
            ):
                turns = parse(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                told = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((conv, len(turns), _sha(told), len(loss), _sha(loss), len(text), rewrites))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in DIGEST.split(", ")])

    return formatted.mapInPandas(run, DIGEST)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
