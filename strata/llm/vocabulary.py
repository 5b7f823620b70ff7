"""A byte-level BPE vocabulary file: tokens, merges, and how two tokens may stand side by side."""

from __future__ import annotations

import json
from functools import lru_cache

#: Fixed value: the pattern that cuts texts before the merges of byte-level vocabularies.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NEVER = 1 << 40


def _byte_of_letter() -> dict[str, int]:
    """Vocabulary files write a byte as the letter of its number if that is visible, else as one from 256 on."""
    seen = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    letters = {chr(b): b for b in seen}
    hidden = (b for b in range(256) if b not in letters.values())
    return letters | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes with the merge that makes each.

    ``right_edge[t]`` are the tokens that stand at the right end of t's bytes while merges run,
    each with the rank of the merge that ends it; ``left_edge`` is the same for the left end.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_of_letter()
        model, self.special = spec["model"], {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = 1 + max([*model["vocab"].values(), *self.special.values()])
        self.tokens: list[bytes] = [b""] * size
        for text, number in model["vocab"].items():
            if text not in self.special:
                self.tokens[number] = bytes(letters[c] for c in text)
        self.ids = {token: number for number, token in enumerate(self.tokens) if token}
        for text, number in self.special.items():
            self.tokens[number] = text.encode("utf-8")
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = model["vocab"][left], model["vocab"][right]
            self.rank[pair] = rank
            parts.setdefault(model["vocab"][left + right], pair)
        self._parts = parts
        self.right_edge = [self._edge(t, 1) for t in range(size)]
        self.left_edge = [self._edge(t, 0) for t in range(size)]
        self.known_beside: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> tuple[tuple[int, int], ...]:
        edge, ends = [], _NEVER
        while True:
            edge.append((token, ends))
            pair = self._parts.get(token)
            if pair is None:
                return tuple(edge)
            ends = self.rank[pair]
            token = pair[side]

    def _no_merge_across(self, left: int, right: int, before: int) -> bool:
        """Does no merge join the end of ``left`` with the start of ``right`` before rank ``before``?

        Of merges of the same rank, the one further left goes first.
        """
        for a, a_ends in self.right_edge[left]:
            for b, b_ends in self.left_edge[right]:
                rank = self.rank.get((a, b))
                if rank is not None and rank < min(a_ends, before) and rank <= b_ends:
                    return False
        return True

    def beside(self, left: int, right: int) -> bool:
        """Are the bytes of both tokens together encoded as just these two tokens?"""
        pair = left << 32 | right
        known = self.known_beside.get(pair)
        if known is None:
            if len(self.known_beside) > 200_000:  # what is known can be found again
                self.known_beside.clear()
            known = self.known_beside[pair] = self._no_merge_across(left, right, _NEVER)
        return known

    def whole(self, token: int) -> bool:
        """Are the bytes of the token encoded as the token itself?"""
        known = self._whole.get(token)
        if known is None:
            pair = self._parts.get(token)
            known = pair is None or (
                self.whole(pair[0]) and self.whole(pair[1]) and self._no_merge_across(*pair, self.rank[pair])
            )
            self._whole[token] = known
        return known


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """The vocabulary of a file, read once by a worker."""
    return Vocabulary(path)
