"""Rank files of byte-level BPE vocabularies, and the split of texts into chunks."""

from __future__ import annotations

import base64
import re

# A chunk ends before a full stop or comma that follows an ASCII letter, and where a
# character that is no white space is followed by a space or a line feed. No match of a pre-token pattern crosses such a place: white space is
# continued by white space only, and letters by letters; so the ids of a text are those
# of its chunks.
_CHUNK = re.compile(
    r"\s*[^\s.,]++(?<=[A-Za-z])(?=[.,])|\s*\S+(?:[^\S \n]\s*\S*)*|\s+"
)
_AFTER_LETTER = re.compile(r"[.,](?<=[a-z][.,])")


def chunks(text: str) -> list[str]:
    return _CHUNK.findall(text)


def words(text: str) -> list[str]:
    """Runs of characters other than space and line feed, cut where chunks may be.

    For tokenizers that drop white space and case; ASCII letters are lower-case here.
    """
    lower = text.encode().lower().decode().replace("\n", " ")
    return list(filter(None, _AFTER_LETTER.sub(r" \g<0>", lower).split(" ")))


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by id."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path} has gaps in its ranks")
    return [ranks[i] for i in range(len(ranks))]
