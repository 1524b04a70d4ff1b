"""Whole texts to token ids, with a public vocabulary file given by its path."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

import tokenizers  # noqa: E402

#: Pieces of text whose ids one Python worker remembers; later ones are encoded each time.
REMEMBERED = 700_000
#: A stop or comma between a letter and a blank.
_STOP = re.compile(rb"(?<=[a-z])([.,])(?=[ \n])")
#: Small letters that no normalising changes, and signs that are no letter, digit or apostrophe.
_PLAIN = re.compile(r"([a-z\xdf-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)")
#: The sign that stands for each byte in a byte-level vocabulary: itself if it is printed, else one above 255.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SIGNS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_OPEN: dict[str, WordIds] = {}


class WordIds:
    """Ids of a text by a tokenizer that never joins text across white space.

    Such a tokenizer (one that lowers its text, drops white space and parts
    letters from other signs before it merges) gives the ids of a text as
    those of its white-space separated parts, one after the other. Parts
    repeat, so their ids are looked up; new parts go to the tokenizer in one
    batch per text. They repeat more often without capitals and without the
    stop or comma after a word, so these are taken off first, unless the text
    holds what might spell a special token or a letter of several signs.

    A new part of small letters, with or without signs after them, needs no
    normalising and is one or two words of the vocabulary's merges, so those
    are asked for directly. That holds for a byte-level vocabulary; whether
    this is one is seen on the letters themselves.
    """

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.model = self.tokenizer.model
        probes = ["the", "these!", "x#$%", *map(chr, range(0xDF, 0x100)), "caf\xe9s,", "\xfcber\xdf_"]
        self.direct = all(
            self._merged(p) in (None, self.tokenizer.encode(p, add_special_tokens=False).ids) for p in probes
        )

    def _merged(self, part: str) -> list[int] | None:
        """The ids of small letters and the signs after them by the merges alone; None for other parts."""
        if not (found := _PLAIN.fullmatch(part)):
            return None
        letters, signs = found.groups()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_BYTE_SIGNS)
        ids = [t.id for t in self.model.tokenize(letters)]
        return ids + [t.id for t in self.model.tokenize(signs)] if signs else ids

    def _encoded(self, new: Iterable[bytes]) -> dict[bytes, bytes]:
        coded, other = {}, []
        for part in new:
            ids = self._merged(part.decode("utf-8")) if self.direct else None
            if ids is None:
                other.append(part)
            else:
                coded[part] = struct.pack(f"<{len(ids)}I", *ids)
        if other:
            found = self.tokenizer.encode_batch_fast([p.decode("utf-8") for p in other], add_special_tokens=False)
            coded.update((p, struct.pack(f"<{len(x)}I", *x.ids)) for p, x in zip(other, found))
        return coded

    def ids(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids of a UTF-8 text."""
        if not (b"<|" in text or b"\xcc" in text or b"\xcd" in text):
            text = _STOP.sub(rb" \1", text.lower())
        parts, known = text.split(), self.known
        found = list(map(known.get, parts))
        try:
            return b"".join(found)
        except TypeError:  # some are new
            coded = self._encoded({p for p, ids in zip(parts, found) if ids is None})
        if len(known) + len(coded) <= REMEMBERED:
            known |= coded
        return b"".join([coded[p] if ids is None else ids for p, ids in zip(parts, found)])


def word_ids(path: str) -> WordIds:
    """The tokenizer of ``path``, opened once per Python worker."""
    if path not in _OPEN:
        _OPEN[path] = WordIds(path)
    return _OPEN[path]
