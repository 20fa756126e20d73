"""How one word is cut into pieces; small helpers of the encoding and training jobs."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Mapping

UNKNOWN_PENALTY = 10.0
LONGEST_WORD = 100


def merge_split(word: str, ranks: Mapping[tuple[str, str], int]) -> list[str]:
    """Characters merged pair by pair, the earliest learned pair first, from left to right."""
    return merge_pieces(list(word), ranks, lambda pair: pair[0] + pair[1])


def merge_pieces[P](
    pieces: list[P | None], ranks: Mapping[tuple[P, P], int], joined: Callable[[tuple[P, P]], P]
) -> list[P]:
    """``pieces`` merged in the order of ``ranks``; ``joined`` names what a pair becomes.

    Neighbouring pairs wait in a heap by rank and place, so n pieces take O(n log n) steps
    however many merges apply.
    """
    size = len(pieces)
    heap = [
        (ranks[pair], at, pair) for at, pair in enumerate(zip(pieces, pieces[1:])) if pair in ranks
    ]
    if not heap:
        return pieces
    pieces = list(pieces)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    heapq.heapify(heap)
    while heap:
        _, at, pair = heapq.heappop(heap)
        right = after[at]
        if pieces[at] != pair[0] or right >= size or pieces[right] != pair[1]:
            continue  # one of the two was merged meanwhile
        pieces[at], pieces[right] = joined(pair), None
        after[at] = after[right]
        if after[at] < size:
            before[after[at]] = at
        for left in (before[at], at):
            if left >= 0 and after[left] < size:
                beside = (pieces[left], pieces[after[left]])
                if beside in ranks:
                    heapq.heappush(heap, (ranks[beside], left, beside))
    return [piece for piece in pieces if piece is not None]


def longest_match_split(
    word: str,
    vocabulary: Mapping[str, int],
    prefix: str,
    unknown: str,
    longest_word: int | None = LONGEST_WORD,
    longest_piece: int | None = None,
) -> list[str]:
    """The longest known piece from the left, again and again; none makes the word unknown.

    So does a length above ``longest_word``, if given. ``longest_piece`` bounds the search.
    """
    if longest_word is not None and len(word) > longest_word:
        return [unknown]
    reach = longest_piece or len(word)
    pieces, start = [], 0
    while start < len(word):
        for end in range(min(len(word), start + reach), start, -1):
            piece = (prefix if start else "") + word[start:end]
            if piece in vocabulary:
                break
        else:
            return [unknown]
        pieces.append(piece)
        start = end
    return pieces


def unknown_score(scores: Mapping[str, float]) -> float:
    """What a character without a piece of its own scores: far below all pieces."""
    return min(scores.values(), default=0.0) - UNKNOWN_PENALTY


def best_split(
    word: str, scores: Mapping[str, float], longest: int, floor: float
) -> tuple[list[str], float]:
    """The segmentation with the highest total score and that score.

    A character without a piece of its own scores ``floor``.
    """
    reached: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            score = scores.get(word[start:end])
            if score is None:
                if end - start > 1:
                    continue
                score = floor
            options.append((reached[start][0] + score, start))
        reached.append(max(options))
    pieces, end = [], len(word)
    while end:
        start = reached[end][1]
        pieces.append(word[start:end])
        end = start
    return pieces[::-1], reached[-1][0]
