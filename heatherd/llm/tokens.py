"""Token ids of whole texts with a public tokenizer, one encoding per distinct piece and worker process.

A text is cut only where the tokenizer's own pre-tokenizer always cuts, so the ids of the pieces in
a row are the ids of the text. Pieces repeat a lot; their ids are kept as little-endian bytes, for
all tasks of a Python worker, and joined. A new piece of Latin letters goes to the tokenizer's model, as
the steps before it take letter by letter there; any other one goes through all of them. A text with the
string of a special token is encoded in one piece, as the library does it.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np

from heatherd.session import ship_by_value

# White space and format characters beyond ASCII, on which regular expression engines differ, and
# control characters that some count as white space: a text with one is encoded in one piece.
UNSURE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
CONTROLS = "\x1c\x1d\x1e\x1f"  # those of ASCII
# Letters up to a plain mark or white space, which every pre-tokenizer here takes as one piece; else
# a word with the space before it, the white space before that, a last white space of another kind.
ALPHABET = "".join(chr(c) for c in range(0x41, 0x100) if chr(c).isalpha() and (c < 0x7B or c >= 0xC0))
LETTERS = r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]++(?![^ \t-\r.,;:!?*#$%&])"
PLAIN = re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
WORD = re.compile(rf"{LETTERS}|[^ \t-\r]+")
SPACED = re.compile(rf" ?{LETTERS}| ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]")
LONG = 200  # characters; longer pieces are not remembered
LIMIT = 300_000  # remembered pieces, and as many of those met before them
# A long text is encoded in parts of about so many characters, cut where two plain words meet.
PART = 500_000
SEAM = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def parted(text: str) -> Iterator[str]:
    begin = 0
    while (seam := SEAM.search(text, begin + PART)) is not None:
        yield text[begin : seam.start()]
        begin = seam.start()
    yield text[begin:]


def shared(path: str, spaces: bool) -> Pieces:
    """The pieces met by any task of this worker process.

    The module itself travels with each task, so they hang on one that does not.
    """
    holder = sys.modules.setdefault("_heatherd_token_pieces", types.ModuleType("_heatherd_token_pieces"))
    if (key := f"{path}|{spaces}") not in holder.__dict__:
        holder.__dict__[key] = Pieces(path, spaces)
    return holder.__dict__[key]


class Pieces(dict):
    """Ids of pieces, as little-endian unsigned 32-bit bytes.

    When `LIMIT` are held they become the old ones, which come back when met; those before are forgotten.
    """

    def __init__(self, path: str, spaces: bool):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.old: dict[str, bytes] = {}

        def before(seen: str) -> list[str]:
            normal = self.tokenizer.normalizer.normalize_str(seen) if self.tokenizer.normalizer else seen
            return [cut for cut, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

        # what the model gets of a piece of letters, if the steps before it take them one by one and cut none
        self.letters = str.maketrans({one: "".join(before(one)) for one in ALPHABET + " " * spaces})
        every = " " * spaces + ALPHABET
        self.plain = before(every) == [every.translate(self.letters)]

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.by_model(piece) if self.plain and PLAIN.fullmatch(piece) else self.whole(piece)
        if len(piece) <= LONG:
            if len(self) >= LIMIT:
                self.old = self.copy()
                self.clear()
            self[piece] = ids
        return ids

    def by_model(self, piece: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(piece.translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def whole(self, text: str) -> bytes:
        """Ids of a text by all steps of the tokenizer."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


class Encoder:
    """`encode(texts)` gives the ids of each as little-endian unsigned 32-bit bytes.

    `spaces` tells a vocabulary whose pieces keep the space before a word from one that drops
    white space.
    """

    def __init__(self, path: str, spaces: bool):
        self.known, self.spaces = shared(path, spaces), spaces
        self.added = [one.content.lower() for one in self.known.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, texts: list[str]) -> list[bytes]:
        return [b"".join(map(self.ids, parted(text))) if len(text) > PART else self.ids(text) for text in texts]

    def ids(self, text: str) -> bytes:
        if self.unsure(text):
            return self.known.whole(text)
        return b"".join(map(self.known.__getitem__, self.pieces(text)))

    def unsure(self, text: str) -> bool:
        low = text.lower()
        if any(one in low for one in self.added):
            return True
        return any(control in text for control in CONTROLS) if text.isascii() else UNSURE.search(text) is not None

    def pieces(self, text: str) -> list[str]:
        if self.spaces:
            return SPACED.findall(text)
        return WORD.findall(text.encode().lower().decode())  # of bytes: A-Z only, which this vocabulary does not tell from a-z


ship_by_value(__name__)
