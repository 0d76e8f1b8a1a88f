"""The tokenizers library inside tasks: each piece of text a task meets is encoded once."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np

from paytally.llm.common import IdLists, id_lists_of
from paytally.llm.vocab import chunks, words


class LibraryEncoder:
    """Ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives.

    The strings of special tokens are ordinary text, unless ``special``: then a text that
    may hold an added token goes to the library whole. Other texts are cut where no pre-token
    crosses (``chunks`` for byte-level vocabularies, ``words`` for such as drop white
    space), and the library encodes each distinct piece.
    """

    def __init__(self, definition: str, special: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = not special
        added = self.library.get_added_tokens_decoder().values() if special else ()
        # The normaliser may change case before tokens are looked for.
        self.added = [t.content.lower() for t in added]
        drops_white_space = '"behavior":"Removed"' in definition.replace(" ", "").replace("\n", "")
        self.spaced = not drops_white_space
        self.pieces: Callable[[str], list[str]] = words if drops_white_space else chunks
        # Byte-level vocabularies are written with a printable character for each byte:
        # its own if it has one, else the next from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in shown]
        self._spelling = {b: 256 + k for k, b in enumerate(others)}
        self.known = IdLists()

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of distinct pieces.

        A piece that is one pre-token for certain goes to the library's model at once:
        letters only, after one space where the vocabulary has them, with nothing for
        the normaliser to change. All others take the library's whole way.
        """
        out: list[list[int] | None] = [None] * len(pieces)
        tokenize, spell, other = self.library.model.tokenize, self._spelling, []
        space = chr(spell[ord(" ")])
        for k, piece in enumerate(pieces):
            after_space = self.spaced and piece[0] == " "
            letters = piece[1:] if after_space else piece
            if not letters.isalpha():
                other.append(k)
                continue
            if not letters.isascii():
                if not self.spaced and not (
                    letters == letters.lower() and is_normalized("NFC", letters)
                ):
                    other.append(k)
                    continue
                letters = letters.encode().decode("latin-1").translate(spell)
            out[k] = [t.id for t in tokenize(space + letters if after_space else letters)]
        rest = self.library.encode_batch_fast(
            [pieces[k] for k in other], add_special_tokens=False
        )
        for k, encoding in zip(other, rest, strict=True):
            out[k] = encoding.ids
        return out

    def _holds_added(self, text: str) -> bool:
        lower = text.lower()
        return any(token in lower for token in self.added)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        whole = {k for k, text in enumerate(texts) if self._holds_added(text)} if self.added else ()
        by_pieces = ["" if k in whole else text for k, text in enumerate(texts)] if whole else texts
        for k, ids in id_lists_of(by_pieces, self.pieces, self._encode, self.known):
            if k in whole:
                ids = self.library.encode(texts[k], add_special_tokens=False).ids
                ids = np.array(ids, np.uint32)
            yield ids


@lru_cache(maxsize=2)
def library_encoder(definition: str) -> LibraryEncoder:
    """One encoder per worker, so that what it has met serves its later tasks."""
    return LibraryEncoder(definition, special=True)


def definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
