"""Token ids of texts by a tokenizer file, with the ids of frequent stretches remembered.

The tokenizers read here split a text into stretches before they merge anything. No stretch crosses the place
where a word ends and ASCII white space begins, or where letters end and another ASCII character follows. So
the ids of a text are the ids of its pieces, each piece being white space with the letters after it, or what
stands between those, and pieces repeat. Texts with other white space than ASCII's, and
those that hold the text of a special token, go to the tokenizer whole.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np

_PIECES = re.compile(
    r"[ \t\n\x0b\f\r]*[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[\x00-@\[-`{-\x7f]|\Z)|[ \t\n\x0b\f\r]*[^ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+"
)
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -‍    ⁠　﻿]")


class Encoder:
    """Little-endian 32-bit ids of texts, as bytes. Ids of pieces are remembered up to a bound.

    The pieces of some texts that are not yet known are encoded in one call, a special token between each two:
    text on either side of a special token is encoded on its own.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._border = next(iter(special.items()), None)
        self._most, self._known = most, {}

    def _encode(self, text: str) -> np.ndarray:
        return np.asarray(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, pieces: list[str]) -> None:
        if self._border is None:
            self._known.update((p, self._encode(p).tobytes()) for p in pieces)
            return
        text, border = self._border
        ids = self._encode(text.join(pieces))
        ends = np.append(np.flatnonzero(ids == border), len(ids))
        data, start = ids.tobytes(), 0
        for piece, end in zip(pieces, (ends * 4).tolist()):
            self._known[piece] = data[start:end]
            start = end + 4

    def ids(self, texts: list[str | None]) -> list[bytes]:
        made: list[bytes] = [b""] * len(texts)
        pieces: dict[int, list[str]] = {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if _OTHER_SPACE.search(text) or (self._special and self._special.search(text)):
                made[i] = self._encode(text).tobytes()
            else:
                pieces[i] = _PIECES.findall(text)
        wanted = set().union(*pieces.values())
        if len(self._known) + len(wanted) > self._most:
            # The half learned first stays: frequent pieces are met early.
            self._known = dict(islice(self._known.items(), self._most // 2))
        new = wanted.difference(self._known)
        if new:
            self._learn(list(new))
        known = self._known.__getitem__
        for i, parts in pieces.items():
            made[i] = b"".join(map(known, parts))
        return made


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, one in each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
