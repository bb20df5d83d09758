"""Byte-level encoding of any text, also of one that is a single endless run."""

from __future__ import annotations

import json
import re

# Fixed value: how the public vocabulary cuts a text before merging.
PATTERN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# White space as the pattern means it, of which a run this long is cut out first:
# the pattern looks back along the whole run and does not survive a million signs.
LONG_RUN = 1 << 15
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG = re.compile(_SPACE + "{%d,}" % LONG_RUN)


def byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 as it is, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks_of(model: bytes) -> dict[bytes, int]:
    """Bytes and id of each entry of a byte-level vocabulary in JSON.

    Ids are ranks: an entry of a smaller id is merged first. Special entries,
    whose ids come after all others, are none.
    """
    found, letters = json.loads(model), byte_letters()
    special = {entry["content"] for entry in found.get("added_tokens", ())}
    return {
        bytes(letters[c] for c in entry): rank
        for entry, rank in found["model"]["vocab"].items()
        if entry not in special
    }


def encoder_of(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding(
        "text", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def encode(encoder, text: str) -> list[int]:
    """Ids of a text without special tokens.

    A long run of white space is one piece to the pattern, but for its last sign
    where something follows. It is merged as that piece; what lies around it is
    encoded by itself, as no other piece can reach into it.
    """
    ids, start = [], 0
    for run in _LONG.finditer(text):
        end = run.end() - (run.end() < len(text))
        ids += encoder.encode_ordinary(text[start : run.start()])
        ids += encoder._encode_single_piece(text[run.start() : end])
        start = end
    return ids + encoder.encode_ordinary(text[start:])
