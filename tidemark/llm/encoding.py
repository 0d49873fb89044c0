"""Token ids of many texts with a public tokenizer, each distinct word being encoded once.

Both supported pre-tokenizers never join characters across a single space that stands between
two characters that are not white space: such a space ends one token and may only start the
next. So a text is cut there into pieces. A piece that is new, but made of Latin letters and
plain ASCII only, is cut again between letters and other characters, where they do not join
characters either. Ids of pieces and of their parts are kept for the next time they come.

Runs of letters that are new in a text are encoded as one string, with a digit between each two:
a digit joins no letter and no space, so its id shows where the ids of one run end.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Sequence

_BREAK = re.compile(r"(?<=\S) (?=\S)")
_LOOSE = re.compile(r"\s | \s")  # a space that ``_BREAK`` leaves
# No quote, as it joins the letters after it, no white space but single line feeds, and no
# dotted capital I, whose lower case is more than a letter.
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_PLAIN = r"0-9!-&(-/:-@\[-`{-~"
_PARTS = re.compile(rf"[{_LATIN}]+|[^{_LATIN}]+")
_SIMPLE = re.compile(rf"[{_LATIN}{_PLAIN}]+(?:\n[{_LATIN}{_PLAIN}]+)*")
_RUN = re.compile(rf" ?[{_LATIN}]+")
_BETWEEN = "0"
KEPT = 1_200_000
KEPT_CUT = 200_000  # of these, pieces of several parts, which are cheap to put together again
KEPT_CHARS = 48
_encoders: dict[tuple, PieceEncoder] = {}


class PieceEncoder:
    """Ids as little-endian bytes of ``width`` bytes each.

    A bounded number of short pieces and parts is remembered; further ones are encoded each time.
    """

    def __init__(self, path: str, width: int = 2) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 256**width:
            raise ValueError(f"ids of {path} need more than {width} bytes")
        self.width = width
        self.code = {2: "H", 4: "I"}[width]
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(each.content) for each in added) or "(?!)")
        [[self.between]] = self._ids([_BETWEEN])
        self.pieces: dict[str, bytes] = {}  # of pieces, and first parts of pieces, after a space
        self.alone: dict[str, bytes] = {}  # of first pieces of texts and of further parts
        self.cut = 0  # pieces of several parts

    @classmethod
    def shared(cls, path: str, width: int = 2) -> PieceEncoder:
        """One per Python worker, so that what it remembers serves later tasks too."""
        if (path, width) not in _encoders:
            _encoders[path, width] = cls(path, width)
        return _encoders[path, width]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        return [self._text(text) for text in texts]

    def _text(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        start, ids = self.alone.get(first), list(map(self.pieces.get, rest))
        # Pieces that are empty or have white space at an end are never remembered, so a text
        # that holds one always comes here.
        if start is None or None in ids or _open_end(first):
            new = [at for at, found in enumerate(ids) if found is None]
            loose = new and _LOOSE.search(f"x {' '.join([rest[at] for at in new])} x")
            if loose or _open_end(first):
                first, *rest = _BREAK.split(text)
                ids = list(map(self.pieces.get, rest))
                new = [at for at, found in enumerate(ids) if found is None]
            start, *values = self._new(first, [rest[at] for at in new])
            for at, value in zip(new, values, strict=True):
                ids[at] = value
        return b"".join([start, *ids])

    def _new(self, first: str, pieces: list[str]) -> list[bytes]:
        """Ids of the first piece of a text and of pieces after a space, by way of their parts."""
        known, alone = self.pieces, self.alone
        start = [first] if first in alone else self._parts(first)
        cut = {piece: self._parts(piece) for piece in pieces if not piece.isalpha()}
        heads = {piece for piece in pieces if piece not in cut}
        heads.update(parts[0] for parts in cut.values() if parts[0] not in known)
        others = {part for parts in cut.values() for part in parts[1:] if part not in alone}
        others.update(part for part in start if part not in alone)
        made = self._made([*others, *[" " + head for head in heads]])
        new = {head: made[" " + head] for head in heads}

        def joined(parts: list[str]) -> bytes:
            return b"".join([alone[part] if part in alone else made[part] for part in parts])

        several = {}
        for piece, (head, *more) in cut.items():
            if more:
                several[piece] = (known[head] if head in known else new[head]) + joined(more)
        found = [joined(start), *[several[piece] if piece in several else new[piece] for piece in pieces]]

        # Never one with white space at its end, which may join what follows.
        self._keep(known, [pair for pair in new.items() if not pair[0][-1].isspace()])
        self._keep(alone, [(part, made[part]) for part in others])
        if len(start) > 1:
            self._keep(alone, [(first, found[0])])
        if self.cut < KEPT_CUT and several:
            before = len(known)
            self._keep(known, list(several.items()))
            self.cut += len(known) - before
        return found

    def _keep(self, known: dict[str, bytes], found: list[tuple[str, bytes]]) -> None:
        if len(self.pieces) + len(self.alone) < KEPT:
            known.update((piece, ids) for piece, ids in found if len(piece) <= KEPT_CHARS)

    def _parts(self, piece: str) -> list[str]:
        if _SIMPLE.fullmatch(piece) and not self.special.search(piece):
            return _PARTS.findall(piece)
        return [piece]

    def _made(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of each part, runs of letters being encoded as one string."""
        runs: list[str] = []
        others: list[str] = []
        for part in parts:
            (runs if _RUN.fullmatch(part) else others).append(part)
        ids, *more = self._ids([_BETWEEN.join(runs), *others])
        made = {part: array(self.code, each).tobytes() for part, each in zip(others, more, strict=True)}
        stops = [at for at, found in enumerate(ids) if found == self.between] + [len(ids)]
        whole, at = array(self.code, ids).tobytes(), 0
        for run, stop in zip(runs, stops if runs else [], strict=True):
            made[run] = whole[at * self.width : stop * self.width]
            at = stop + 1
        return made

    def _ids(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [each.ids for each in found]


def _open_end(first: str) -> bool:
    return not first or first[-1].isspace()


def crc32_of_u32(ids: bytes, dtype: str) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    import zlib

    import numpy as np

    return zlib.crc32(np.frombuffer(ids, dtype=dtype).astype("<u4").tobytes())
