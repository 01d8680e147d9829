"""The fixed public piece vocabulary of a SentencePiece model file, read without that library.

The file is a protocol-buffer message: field 1 repeats the pieces, each with
its string (field 1), score (field 2, float) and type (field 3: 1 normal,
2 unknown, 3 control, 6 byte).
"""

from __future__ import annotations

import os
import struct
from dataclasses import dataclass
from functools import lru_cache

#: Folder of the public vocabulary files; a parameter of every operator that needs one.
TOKENIZERS = os.environ.get("EVENTLENS_TOKENIZERS", "/opt/tokenizers")
MODEL = "piece_bpe_32k.model"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


@dataclass(frozen=True)
class Piece:
    id: int
    text: str
    score: float
    kind: int


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (b[i] & 0x7F) << shift
        shift += 7
        i += 1
        if b[i - 1] < 0x80:
            return value, i


def _fields(b: bytes):
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        wire = tag & 7
        if wire == 0:
            value, i = _varint(b, i)
        elif wire == 2:
            n, i = _varint(b, i)
            value, i = b[i:i + n], i + n
        elif wire == 5:
            value, i = b[i:i + 4], i + 4
        elif wire == 1:
            value, i = b[i:i + 8], i + 8
        else:
            raise ValueError(f"unexpected wire type {wire}")
        yield tag >> 3, value


@lru_cache(maxsize=4)
def read_pieces(path: str | None = None) -> tuple[Piece, ...]:
    """All pieces of the model file, by id."""
    with open(path or os.path.join(TOKENIZERS, MODEL), "rb") as f:
        data = f.read()
    out = []
    for number, value in _fields(data):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for k, v in _fields(value):
                if k == 1:
                    text = v.decode()
                elif k == 2:
                    score = struct.unpack("<f", v)[0]
                elif k == 3:
                    kind = v
            out.append(Piece(len(out), text, score, kind))
    return tuple(out)
