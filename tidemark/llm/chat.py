"""Chat formatting of conversations with a compiled template, and reading the output back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import arrow
from tidemark.llm.templates import Template, unescape

TEMPLATE = (
    "{% for m in messages %}[INST]{{ m.role | escape }}[/INST]"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}</s>{% endfor %}"
)
TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, text, begin, end): each conversation rendered, with the generation spans in code points.

    Turns go by (turn, role, text), nulls first; null roles and texts are empty; repeated rows are turns of their own; rows
    with a null conv_id are one conversation; an empty table gives no rows. A conversation is one string, so its turns
    meet in one task; nothing else does. Other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template)
        for batch in batches:
            done = [compiled.render(messages=turns) for turns in batch.column(1).to_pylist()]
            spans = [[[s[k] for s in found] for _, found in done] for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in done], pa.string()), *(pa.array(x, pa.list_(pa.int32())) for x in spans)], ["conv_id", "text", "begin", "end"])

    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return arrow(grouped, scan, "conv_id long, text string, begin array<int>, end array<int>")


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a text made by TEMPLATE."""
    turns = TURN.findall(text)
    if sum(len(r) + len(t) + len("[INST][/INST]</s>") for r, t in turns) != len(text):
        raise ValueError("not a formatted conversation")
    return [(unescape(r), unescape(t)) for r, t in turns]


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from formatted text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, text, begin, end in zip(*(c.to_pylist() for c in batch.columns)):
                turns = read_turns(text)
                loss = "".join(unescape(text[a:b]) for a, b in zip(begin, end))
                sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in turns), loss)]
                rows.append({"conv_id": conv, "n_turns": len(turns), "turns_sha256": sha[0], "loss_chars": len(loss), "loss_sha256": sha[1], "formatted_chars": len(text)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))

    return arrow(formatted.select("conv_id", "text", "begin", "end"), scan, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
