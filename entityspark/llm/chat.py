"""Chat formatting with typed content parts, a loss mask and a reversible escape of control strings."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import arrow_batches

START, END, SEP = "<|im_start|>", "<|im_end|>", "\n"
#: Marks the template's strings inside texts; itself doubled there, so every text comes back exactly.
ESCAPE = "\\"
_CONTROL = re.compile(r"[\\<]")
_BACK = re.compile(r"\\([\\ln])")
_PLAIN = {"\\": "\\", "l": "<", "n": "\n"}
#: Tokens that one part of a kind stands for unless it names its own number.
EXPANSION = {"image": 576, "audio": 750, "document": 1024}


def escape(text: str) -> str:
    """`\\` becomes `\\\\` and `<` becomes `\\l`, so no escaped text holds a control string or part of one."""
    return _CONTROL.sub(lambda m: ESCAPE + ("l" if m[0] == "<" else ESCAPE), text)


def escape_role(role: str) -> str:
    """As escape(), with line breaks as `\\n`: the first line break of a turn ends its role."""
    return escape(role).replace("\n", ESCAPE + "n")


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: _PLAIN[m[1]], text)


class PartVisitor:
    """Flattens typed parts into one text: text parts as they are (escaped), others as placeholders, numbered by their
    turn and their place in it, so that no two of a conversation are the same, each with an attachment reference and its
    expanded token count."""

    def __init__(self, turn: int | None = 0) -> None:
        self.turn = "" if turn is None else turn
        self.out: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(str(part.get("text") or "")))

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"place": len(self.attachments), "kind": kind, "ref": str(part.get("ref") or part.get("url") or ""), "tokens": tokens})
        self.out.append(f"<|{kind}_{self.turn}_{len(self.attachments) - 1}|>")

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, int(part.get("tokens") or EXPANSION["image"]))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, int(part.get("tokens") or EXPANSION["audio"]))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, int(part.get("tokens") or EXPANSION["document"] * max(1, int(part.get("pages") or 1))))

    def visit_unknown(self, part: dict) -> None:
        self.out.append(escape(json.dumps(part, ensure_ascii=False, sort_keys=True)))


def flatten_parts(parts: list[dict], turn: int | None = 0) -> tuple[str, list[dict]]:
    """A turn's escaped body and its attachments, in order."""
    visitor = PartVisitor(turn)
    for part in parts:
        visitor.visit({k: v for k, v in part.items() if v is not None})
    return "".join(visitor.out), visitor.attachments


_PLACEHOLDER = re.compile(r"<\|([a-z]+)_(-?\d*)_(\d+)\|>")


def read_parts(body: str, attachments: list[dict]) -> list[dict]:
    """The typed parts of a turn's escaped body, with its attachments, in order. A placeholder can't be taken for text:
    a `<` of a text is never written as such."""
    out, at = [], 0
    for m in _PLACEHOLDER.finditer(body):
        if m.start() > at:
            out.append({"type": "text", "text": unescape(body[at:m.start()])})
        found = attachments[int(m[3])]
        out.append({"type": m[1], "ref": found["ref"], "tokens": found["tokens"]})
        at = m.end()
    return out + ([{"type": "text", "text": unescape(body[at:])}] if at < len(body) else [])


def turns(conversations: DataFrame, parts_col: str | None = None) -> DataFrame:
    """One formatted row per turn: conv_id, turn, role, formatted, loss_from, loss_to (the mask's span in it),
    attachments and expanded_tokens. Row-local, so one conversation may be of any length.

    parts_col: an array of structs with type and any of text, ref, url, tokens, pages; without it the column text is
    the turn's only part. Null role, text and parts: empty; repeated rows are turns each; other columns are left out.
    """
    arrow_batches(conversations.sparkSession)
    content = F.col(parts_col) if parts_col else F.coalesce("text", F.lit(""))
    d = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), content.alias("content"))
    kind = "array<struct<place:int,kind:string,ref:string,tokens:int>>"
    at = pa.list_(pa.struct([("place", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int32())]))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            formatted, low, high, attached, tokens = [], [], [], [], []
            for turn, role, content in zip(*(batch.column(c).to_pylist() for c in ("turn", "role", "content"))):
                body, found = flatten_parts((content or []) if parts_col else [{"type": "text", "text": content}], turn)
                head = f"{START}{escape_role(role)}{SEP}"
                formatted.append(f"{head}{body}{END}{SEP}")
                low.append(len(head))
                high.append(len(head) + len(body) if role == "assistant" else len(head))
                attached.append(found)
                tokens.append(sum(x["tokens"] for x in found))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(formatted, pa.string()), pa.array(low, pa.int32()),
                                              pa.array(high, pa.int32()), pa.array(attached, at), pa.array(tokens, pa.int64())],
                                             ["conv_id", "turn", "role", "formatted", "loss_from", "loss_to", "attachments", "expanded_tokens"])

    kinds = dict(d.dtypes)
    return d.mapInArrow(render, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, formatted string, loss_from int, loss_to int, attachments {kind}, expanded_tokens long")


def read_back(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, from, to) of every turn of a formatted conversation, texts unescaped, spans of the escaped bodies."""
    at = 0
    while at < len(formatted):
        head = formatted.index(SEP, at)
        end = formatted.index(END, head)
        yield unescape(formatted[at + len(START):head]), unescape(formatted[head + 1:end]), head + 1, end
        at = end + len(END) + len(SEP)


def conversation_digests(rendered: DataFrame, block: int = 256) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the rendered turns.

    Turns are gathered in order of turn (nulls first; ties: role, then text) into blocks first, so a conversation that holds a large
    share of all rows is gathered in many tasks; what then meets for one conversation is its own formatted text, which
    is streamed through the digests block by block.
    """
    spark = rendered.sparkSession
    arrow_batches(spark)
    kind = dict(rendered.dtypes)["conv_id"]
    r = rendered.select("conv_id", F.floor(F.col("turn") / block).alias("block"), F.struct("turn", "role", "formatted", "loss_from", "loss_to").alias("t"))
    blocks = r.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("t"))
    blocks = blocks.select("conv_id", "block", *(F.col(f"t.{c}").alias(c) for c in ("formatted", "loss_from", "loss_to")))
    blocks = blocks.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("block"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []

        def closed() -> tuple:
            return now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in batches:
            for conv, texts, low, high in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if state is None or conv != now:
                    if state is not None:
                        done.append(closed())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for formatted, a, b in zip(texts, low, high):
                    for role, text, _, _ in read_back(formatted):
                        state[0] += 1
                        state[1].update(f"{role}\n{text}\n".encode())
                    learned = unescape(formatted[a:b])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                    state[4] += len(formatted)
            if done:
                yield rows(done)
                done = []
        if state is not None:
            yield rows([closed()])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        c = list(zip(*done))
        kinds = [schema_of[0], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, kinds)],
                                          ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    from pyspark.sql.pandas.types import to_arrow_type

    schema_of = [to_arrow_type(rendered.schema["conv_id"].dataType)]
    return blocks.mapInArrow(digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
