"""Ids of single words under a byte-pair vocabulary with word ends, many words at a time.

The tokenizer file's merges are handed to tiktoken, whose byte-pair merging is an order of
magnitude faster on words that are new, and random words are mostly new. A word end is
written as a byte of its own, which merges first, as the file has it in the last letter.
tiktoken merges any two neighbours that make a token, the file only listed pairs; both come
to the same if no token can be reached by another pair than its listed one, which
``agrees`` finds out for the whole vocabulary. Where it can, and for words with letters
beyond Latin, the tokenizers library encodes.
"""

from __future__ import annotations

import json
import re

import numpy as np
import regex

#: Stand for the end of a word part and for the end of a word; words that hold them go elsewhere.
END, CUT = "\x01", "\x02"
PLAIN = re.compile(r"[!-~¡-ɏ]+")
#: Fixed value: how the tokenizer file cuts words into parts (after lower-casing).
PARTS = regex.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}\x02]+)")
SUFFIX = "</w>"


def letters_of_bytes() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from 256 up."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def ranks_of(path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]]]:
    """(bytes of each token -> id, listed pairs in their order), the word end as a byte."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    byte_of, end = letters_of_bytes(), END.encode()

    def raw(token: str) -> bytes:
        ended = token.endswith(SUFFIX) and token != SUFFIX
        return bytes(byte_of[c] for c in (token[:-len(SUFFIX)] if ended else token)) + (end if ended else b"")

    ranks: dict[bytes, int] = {}
    for token, id_ in model["vocab"].items():
        try:
            ranks.setdefault(raw(token), id_)
        except KeyError:  # special tokens are not spelled in these letters
            continue
    pairs = [tuple(map(raw, p.split(" ") if isinstance(p, str) else p)) for p in model["merges"]]
    return ranks, pairs


def agrees(ranks: dict[bytes, int], pairs: list[tuple[bytes, bytes]]) -> bool:
    """Whether merging any neighbours that make a token does what merging listed pairs does.

    So it is if ids of listed pairs rise with their place, and every token, spelled and merged
    without itself, ends in its listed pair: a token is only ever made from its own letters.
    """
    made = [ranks.get(a + b, -1) for a, b in pairs]
    if min(made, default=0) < 0 or any(x >= y for x, y in zip(made, made[1:])):
        return False
    end = END.encode()
    for left, right in pairs:
        token = left + right
        if token.count(end) > token.endswith(end):
            continue  # spelled with the byte that stands for the end; such words go elsewhere
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(
                ((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b != token)
            )
            if best[0] == 1 << 60:
                return False
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        if parts != [left, right]:
            return False
    return True


class WordCoder:
    """Ids of words; ``fast`` says that ``agrees`` holds for the file."""

    def __init__(self, path: str, fast: bool):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.fast = None
        if fast:
            import tiktoken

            ranks, _ = ranks_of(path)
            self.cut_id = ranks[CUT.encode()]
            self.fast = tiktoken.Encoding(
                "words", pat_str=rf"[^{END}{CUT}]+{END}|{CUT}", mergeable_ranks=ranks, special_tokens={}
            )

    def codes(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit numbers."""
        texts = [w.decode() for w in words]
        plain = [bool(self.fast) and PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        found: list[bytes] = [b""] * len(texts)
        quick = [i for i, p in enumerate(plain) if p]
        if quick:
            spelled = PARTS.sub(rf"\1{END}", CUT.join(texts[i] for i in quick).lower())
            ids = np.array(self.fast.encode_ordinary(spelled), "<u4")
            cuts = 4 * np.flatnonzero(ids == self.cut_id)
            body = ids.tobytes()
            for i, start, stop in zip(quick, [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(body)]):
                found[i] = body[start:stop]
        slow = [i for i, p in enumerate(plain) if not p]
        if slow:
            for i, code in zip(slow, self.whole.encode_batch([texts[i] for i in slow], add_special_tokens=False)):
                found[i] = np.array(code.ids, "<u4").tobytes()
        return found
