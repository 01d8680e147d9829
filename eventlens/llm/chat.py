"""Operator 9: chat formatting by columnar byte assembly."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import words as W

# Control strings that tokenizers read as special tokens.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

CHUNK_BYTES = 8 << 20


@dataclass(frozen=True)
class Template:
    """A turn is ``begin + role + newline + text + end``; roles in ``loss`` are trained on.

    Inside roles and texts a control string gets one more backslash after its
    first character than it had (``</s>`` -> ``<\\/s>``, ``<\\/s>`` -> ``<\\\\/s>``), so
    no control string is left in them and the change can be undone.  A role also
    has its backslashes and newlines escaped.
    """

    begin: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    loss: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = CONTROLS

    def _pattern(self, slashes: str) -> str:
        by_first: dict[str, list[str]] = {}
        for c in self.controls:
            by_first.setdefault(c[0], []).append(re.escape(c[1:]))
        heads = "|".join(f"{re.escape(h)}{slashes}(?:{'|'.join(rest)})" for h, rest in sorted(by_first.items()))
        return heads

    def escape(self, texts: pa.Array) -> pa.Array:
        for first, rest in self._groups():
            texts = pc.replace_substring_regex(texts, f"({first})(\\\\*)({rest})", r"\1\2\\\3")
        return texts

    def unescape(self, text: str) -> str:
        for first, rest in reversed(self._groups()):
            text = re.sub(f"({first})\\\\(\\\\*)({rest})", r"\1\2\3", text)
        return text

    def _groups(self) -> list[tuple[str, str]]:
        """First characters and the alternatives that may follow; one pass for each first character."""
        firsts = sorted({c[0] for c in self.controls})
        return [(re.escape(f), "|".join(re.escape(c[1:]) for c in self.controls if c[0] == f)) for f in firsts]


def escape_role(roles: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)


def assemble(roles: pa.Array, texts: pa.Array, template: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one preallocated buffer: bytes, turn offsets, and where each text starts.

    Segment lengths -> cumulative offsets -> scatter indices; headers and
    contents are copied with one indexed assignment for each column.
    """
    begin, end = (np.frombuffer(s.encode(), np.uint8) for s in (template.begin, template.end))
    role, role_at = W.string_buffers(template.escape(escape_role(roles)))
    text, text_at = W.string_buffers(template.escape(texts))
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    total = len(begin) + role_len + 1 + text_len + len(end)
    at = np.concatenate(([0], np.cumsum(total)))
    out = np.empty(at[-1], np.uint8)
    role_to = at[:-1] + len(begin)
    text_to = role_to + role_len + 1
    out[at[:-1, None] + np.arange(len(begin))] = begin
    out[np.repeat(role_to - role_at[:-1], role_len) + np.arange(len(role))] = role
    out[text_to - 1] = 0x0A
    out[np.repeat(text_to - text_at[:-1], text_len) + np.arange(len(text))] = text
    out[(text_to + text_len)[:, None] + np.arange(len(end))] = end
    return out, at, text_to


def _char_counts(buf: np.ndarray) -> np.ndarray:
    """Code points before each byte."""
    return np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))


def _format(template: Template, chunk_bytes: int):
    schema = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches):
        last, chunk = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            roles, texts = (batch.column(c).fill_null("") for c in ("role", "text"))
            conv = batch.column("conv_id").to_pylist()
            buf, at, text_to = assemble(roles, texts, template)
            chars = _char_counts(buf)
            text_end = at[1:] - len(template.end.encode())
            # A chunk: turns of one conversation, of bounded size.
            cut, numbers = [], []
            for a, b in _runs(conv):
                chunk = chunk + 1 if last is not None and last == (conv[a],) else 0
                last = (conv[a],)
                while a < b:
                    cut.append(a)
                    numbers.append(chunk)
                    a = min(b, max(a + 1, int(np.searchsorted(at, at[a] + chunk_bytes, "right")) - 1))
                    chunk += 1
                chunk -= 1
            cut, ends = np.array(cut), np.array([*cut[1:], len(conv)])
            # The buffer itself is the column's data; only offsets are made.
            edge = np.append(cut, len(conv))
            formatted = pa.StringArray.from_buffers(len(cut), pa.py_buffer(at[edge].astype(np.int32).tobytes()), pa.py_buffer(buf))
            turn = np.flatnonzero(pc.is_in(roles, pa.array(template.loss, pa.string())).to_numpy(zero_copy_only=False))
            base = chars[at[cut[np.searchsorted(cut, turn, "right") - 1]]]
            spans = pa.StructArray.from_arrays([pa.array(chars[text_to[turn]] - base, pa.int64()), pa.array(chars[text_end[turn]] - base, pa.int64())], ["start", "end"])
            loss = pa.ListArray.from_arrays(pa.array(np.searchsorted(turn, edge).astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(cut)), pa.array(numbers, pa.int64()), pa.array(ends - cut, pa.int64()),
                                              formatted, loss], schema=schema)
    return run


def _runs(values: list) -> list[tuple[int, int]]:
    """Ranges of equal neighbours."""
    cuts = [i for i in range(1, len(values)) if values[i] != values[i - 1]]
    return list(zip([0, *cuts], [*cuts, len(values)]))


def format_chats(turns: DataFrame, template: Template = Template(), chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Conversations as training text: ``conv_id, chunk, n_turns, formatted, loss``.

    The text of a conversation is its chunks' ``formatted`` joined in order of
    ``chunk`` (turns are never cut; a chunk is a run of turns of about
    ``chunk_bytes`` at most or one turn).  ``loss`` lists the character ranges
    of the chunk that are trained on: the texts of the roles in
    ``template.loss``, without marks.

    Rows are dealt by conversation and sorted inside the partition, and tasks
    stream over them batch by batch, so neither a long conversation nor a hot
    one is ever held whole.

    Defined results: turns are ordered by turn, then role, then text (nulls
    first), so ties and repeated rows have one order and all stay; null role or
    text counts as empty; null conv_id is a conversation of its own; an empty
    table gives an empty table; other columns are dropped.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(
        _format(template, chunk_bytes),
        "conv_id long, chunk long, n_turns long, formatted string, loss array<struct<start:long,end:long>>")


def parse(formatted: str, template: Template = Template()) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(template.begin, at):
            raise ValueError(f"no turn starts at {at}")
        head = formatted.index("\n", at)
        stop = formatted.index(template.end, head)
        out.append((unescape_role(template.unescape(formatted[at + len(template.begin):head])), template.unescape(formatted[head + 1:stop])))
        at = stop + len(template.end)
    return out


def _digest(template: Template):
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    class State:
        def __init__(self, conv):
            self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
            self.all, self.loss = hashlib.sha256(), hashlib.sha256()

        def row(self):
            return {"conv_id": self.conv, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(), "loss_chars": self.loss_chars,
                    "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}

    def run(batches):
        now = None
        for batch in batches:
            done = []
            for conv, text, loss in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = State(conv)
                for role, body in parse(text, template):
                    now.turns += 1
                    now.all.update(f"{role}\n{body}\n".encode())
                for span in loss:
                    body = template.unescape(text[span["start"]:span["end"]])
                    now.loss_chars += len(body)
                    now.loss.update(body.encode())
                now.chars += len(text)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], schema)
    return run


def read_back(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation, parsed from the output of ``format_chats``.

    ``chats`` must hold a conversation's chunks in one partition, in order, as
    ``format_chats`` returns them (after a detour: repartition by conv_id and
    sort by conv_id and chunk).
    """
    return chats.mapInArrow(_digest(template), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                               "loss_sha256 string, formatted_chars long")
