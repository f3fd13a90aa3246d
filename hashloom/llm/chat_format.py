"""Chat formatting by event-sourced reconstruction.

An event log has one row per event: conversation, sequence number, kind,
target message, role, text. Logs are partitioned by conversation and sorted by
sequence; a fold turns them into final messages, which a template renders.

Kinds: ``message`` (a whole message), ``delta`` (text appended to the target
message, which it begins if new), ``edit`` (replaces the target's text; later
messages of the conversation that answered the old text are dropped only by a
``regenerate``), ``regenerate`` (drops the target and all messages after it,
then begins the target anew with this text), ``delete`` (drops the target).
A delta or edit with a null role keeps the role that is there.

Template: each turn is ``<s>``, the role, ESC ``|``, the text, ``</s>`` and a line
end (ESC: U+001B). Inside roles and texts ESC becomes ESC ``e``, ``<s>`` ESC ``s``,
``</s>`` ESC ``t``, ``[INST]`` ESC ``i`` and ``[/INST]`` ESC ``j``, so none of these
control strings stands in the output but as markup, and reading back is
exact. The loss mask covers each assistant text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Escape character first when writing, last when reading.
CONTROLS = (("<s>", "\x1bs"), ("</s>", "\x1bt"), ("[INST]", "\x1bi"), ("[/INST]", "\x1bj"))
BEGIN, BODY, END = "<s>", "\x1b|", "</s>\n"
KINDS = ("message", "delta", "edit", "regenerate", "delete")


def escape(text: str) -> str:
    text = text.replace("\x1b", "\x1be")
    for plain, coded in CONTROLS:
        text = text.replace(plain, coded)
    return text


def unescape(text: str) -> str:
    if "\x1b" not in text:
        return text
    back = {coded[1]: plain for plain, coded in CONTROLS} | {"e": "\x1b"}
    first, *rest = text.split("\x1b")
    return first + "".join(back[x[0]] + x[1:] for x in rest)


def render(messages: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The formatted text, and the loss mask as a flat list of start, end offsets."""
    out, spans, at = [], [], 0
    for role, text in messages:
        head, body = f"{BEGIN}{escape(role)}{BODY}", escape(text)
        if role == "assistant":
            spans += [at + len(head), at + len(head) + len(body)]
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages that ``render`` was given."""
    turns = []
    for part in formatted.split(END)[:-1]:
        head, _, body = part.partition(BODY)
        turns.append((unescape(head.removeprefix(BEGIN)), unescape(body)))
    return turns


def fold(events) -> list[tuple[str, str]]:
    """Final (role, text) messages of one conversation's events, given in order.

    An event: (kind, target, role, text); a null target of a message is a new
    message, that of another kind the last one. Unknown kinds raise.
    """
    state: dict = {}  # in the order of the messages; a target goes and comes without a search
    for n, (kind, target, role, text) in enumerate(events):
        kind, text = kind or "message", text or ""
        if kind not in KINDS:
            raise ValueError(f"unknown event kind {kind!r}")
        if target is None:
            target = ("#", n) if kind == "message" or not state else next(reversed(state))
        if kind == "regenerate" and target in state:
            role = role or state[target][0]
            while state.popitem()[0] != target:
                continue
        if kind == "delete":
            state.pop(target, None)
        elif target not in state:
            state[target] = [role or "", [text]]
        elif kind == "delta":
            state[target][0] = role or state[target][0]
            state[target][1].append(text)
        else:
            state[target] = [role or state[target][0], [text]]
    return [(role, "".join(texts)) for role, texts in state.values()]


def format_chats(events: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (flat start, end code points) of each conversation.

    ``events``: conv_id long, seq long, kind, target, role, text (strings). A
    partition holds whole conversations, sorted; the fold streams over them and
    holds one conversation at a time, so memory is bounded by the largest
    rendered conversation, however many there are.

    Null kind: message. Null text or role: empty. Null conv_id: one conversation
    of its own. Ties in seq: by kind, target, role and text, so that the result
    doesn't depend on arrival. Repeated rows are separate events. Empty table: no rows.
    Extra columns are not read.
    """
    ordered = (
        events.select(F.col("conv_id").cast("string").alias("conv_id"), "seq", "kind", "target", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", "kind", "target", "role", "text")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = object()
        at, held, out, size = none, [], [], 0

        def done():
            text, spans = render(fold(held))
            out.append((at, text, spans))
            return len(text)

        for pdf in batches:
            ids = pdf["conv_id"].astype(object).where(pdf["conv_id"].notna(), None)
            fields = (pdf[c].astype(object).where(pdf[c].notna(), None) for c in ("kind", "target", "role", "text"))
            for conv, *event in zip(ids, *fields, strict=True):
                if at is none or conv != at:
                    if at is not none:
                        size += done()
                    at, held = conv, []
                    if size > 8_000_000:
                        yield frame(out)
                        out, size = [], 0
                held.append(event)
        if at is not none:
            done()
        if out:
            yield frame(out)

    def frame(rows):
        cols = list(zip(*rows, strict=True))
        return pd.DataFrame({"conv_id": cols[0], "formatted": cols[1], "loss_spans": cols[2]})

    return ordered.mapInPandas(run, "conv_id string, formatted string, loss_spans array<long>").withColumn("conv_id", F.col("conv_id").cast("long"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What can be read from the rendered output alone: counts and digests of turns and of the loss mask.

    ``formatted``: as ``format_chats`` gives it; the text may be empty (no turns), not null. A null conv_id stays, repeated rows are read each, an
    empty table gives no rows, extra columns are not read.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for conv, text, spans in zip(pdf["conv_id"], pdf["formatted"], pdf["loss_spans"], strict=True):
                turns = parse(text)
                digest = hashlib.sha256()
                for role, body in turns:
                    digest.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                masked = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
                rows.append((conv, len(turns), digest.hexdigest(), len(masked), hashlib.sha256(masked.encode("utf-8", "surrogatepass")).hexdigest(), len(text)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.DataFrame(rows, columns=names)

    given = formatted.withColumn("conv_id", F.col("conv_id").cast("string"))
    return given.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumn("conv_id", F.col("conv_id").cast("long"))


def turns_as_events(turns: DataFrame) -> DataFrame:
    """Plain (conv_id, turn, role, text) rows as an event log of whole messages."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("target"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def turns_as_log(turns: DataFrame) -> DataFrame:
    """Plain (conv_id, turn, role, text) rows as the log of a chat that ended in them.

    An assistant's text first streams in as something else, is regenerated, and streams in two deltas; other texts
    stream in two deltas that stand the wrong way round, and are edited; after each message another one is posted and deleted. What
    ``fold`` makes of the log is the rows, by turn, role and text. Null text or role: empty. Repeated rows: messages of their own.
    """
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = rows.withColumn("n", place.cast("long"))
    target, half = F.concat(F.lit("m"), F.col("n")), F.floor(F.char_length("text") / 2).cast("int")
    left, right = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.char_length("text"))
    other = F.concat(target, F.lit(" draft"))

    def event(step, kind, at, role, text):
        null = F.lit(None).cast("string")
        return F.struct((F.col("n") * 8 + step).alias("seq"), F.lit(kind).alias("kind"), at.alias("target"), (null if role is None else role).alias("role"), (null if text is None else text).alias("text"))

    begun = event(0, "message", target, F.col("role"), F.lit(""))
    posted = [event(5, "message", other, F.lit("user"), left), event(6, "delete", other, None, None)]
    answered = F.array(begun, event(1, "delta", target, None, right), event(2, "regenerate", target, None, left), event(3, "delta", target, None, right), *posted)
    asked = F.array(begun, event(1, "delta", target, None, right), event(2, "delta", target, None, left), event(3, "edit", target, None, F.col("text")), *posted)
    return placed.select("conv_id", F.inline(F.when(F.col("role") == "assistant", answered).otherwise(asked)))
