"""Matching blocks of two texts, as the standard library's matcher finds them without its shortcuts, in bounded time.

The longest common stretch (the first in the one text, then the first in the other) parts both texts, and what is left of it and right of it is
matched alike. The library looks for it among all pairs of equal characters. Here stretches of a length and more are found once, as runs of
equal places on one diagonal, and each part takes the longest of those that reach into it, cut to its bounds. Parts without such a stretch look
for shorter ones; texts in which these are too many, as they repeat themselves, are read by an automaton of all substrings, in
one pass over each. Small parts go to the library itself.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np

#: Texts whose lengths multiply to at most this are the library's, which is then faster.
SMALL, TINY = 200_000, 2_000
#: Least lengths of stretches that are looked for one after the other, and how many pairs of places may have one: by characters of both
#: texts, and anyway.
LENGTHS, PAIRS, FEW = (16, 4), 8, 200_000


def longest(a: str, b: str) -> tuple[int, int, int]:
    """(place in a, place in b, length) of the longest common stretch: of several, the first in a, then the first in b."""
    # States are sets of places where a substring of b ends; first is the least of them.
    follow: list[dict[str, int]] = [{}]
    link, size, first, last = [-1], [0], [-1], 0
    for place, c in enumerate(b):
        new = len(follow)
        follow.append({})
        size.append(size[last] + 1)
        first.append(place)
        link.append(0)
        p, last = last, new
        while p != -1 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p == -1:
            continue
        q = follow[p][c]
        if size[q] == size[p] + 1:
            link[new] = q
            continue
        part = len(follow)
        follow.append(follow[q].copy())
        size.append(size[p] + 1)
        first.append(first[q])
        link.append(link[q])
        link[q] = link[new] = part
        while p != -1 and follow[p].get(c) == q:
            follow[p][c] = part
            p = link[p]
    best, state, n = (0, 0, 0), 0, 0
    for place, c in enumerate(a):
        while state and c not in follow[state]:
            state = link[state]
            n = size[state]
        state = follow[state].get(c, 0)
        n = n + 1 if state else 0
        if n > best[2]:
            best = (place - n + 1, first[state] - n + 1, n)
    return best


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _runs(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray | None:
    """Rows (place in a, place in b, length) of the stretches of at least so many characters that can't be made longer; None if too many
    pairs of places begin one. least is a power of 2."""
    m, n = len(a), len(b)
    if min(m, n) < least:
        return np.zeros((0, 3), np.int64)
    # Equal numbers for equal stretches of 1, 2, 4 characters and so on; texts are a gap apart.
    ids = np.concatenate([a + 1, [0], b + 1])
    k = 1
    while k < least:
        _, ids = np.unique(ids[:-k] * (ids.max() + 1) + ids[k:], return_inverse=True)
        k *= 2
    at_a, at_b = ids[: m - least + 1], ids[m + 1 :]
    order = np.argsort(at_b, kind="stable")
    low, high = np.searchsorted(at_b, at_a, "left", order), np.searchsorted(at_b, at_a, "right", order)
    count = high - low
    total = int(count.sum())
    if total > max(PAIRS * (m + n), FEW):
        return None
    x = np.repeat(np.arange(len(at_a)), count)
    y = order[np.repeat(low, count) + np.arange(total) - np.repeat(np.cumsum(count) - count, count)]
    side = x - y
    order = np.lexsort((x, side))
    x, y, side = x[order], y[order], side[order]
    new = np.ones(total, bool)
    new[1:] = (side[1:] != side[:-1]) | (x[1:] != x[:-1] + 1)
    first = np.flatnonzero(new)
    return np.stack([x[first], y[first], np.diff(np.append(first, total)) + least - 1], 1)


def _within(runs: np.ndarray, i: int, m: int, j: int, n: int, least: int) -> np.ndarray:
    """Runs cut to a part of both texts, without those that are then too short."""
    x, y, k = runs[:, 0], runs[:, 1], runs[:, 2]
    skip = np.maximum(np.maximum(i - x, j - y), 0)
    size = np.minimum(np.minimum(m - x, n - y), k) - skip
    stay = size >= least
    return np.stack([(x + skip)[stay], (y + skip)[stay], size[stay]], 1)


def matching_blocks(a: str, b: str) -> list[tuple[int, int, int]]:
    """(place in a, place in b, length) of equal stretches in order, those that touch each other as one."""
    if a == b:
        return [(0, 0, len(a))] if a else []
    found: list[tuple[int, int, int]] = []
    codes: tuple[np.ndarray, np.ndarray] | None = None
    # A part of both texts, which of LENGTHS its runs have at least, and these, or None if they aren't known yet.
    todo: list[tuple[int, int, int, int, int, np.ndarray | None]] = [(0, len(a), 0, len(b), 0, None)]
    while todo:
        i, m, j, n, level, runs = todo.pop()
        area = (m - i) * (n - j)
        if not area:
            continue
        if area > TINY and level < len(LENGTHS):
            least = LENGTHS[level]
            if runs is None:
                codes = codes or (_codes(a), _codes(b))
                runs = _runs(codes[0][i:m], codes[1][j:n], least)
                runs = runs if runs is None else runs + (i, j, 0)
            if runs is not None and not len(runs):
                todo.append((i, m, j, n, level + 1, None))
                continue
            if runs is not None:
                best = np.lexsort((runs[:, 1], runs[:, 0], -runs[:, 2]))[0] if len(runs) > 1 else 0
                x, y, k = runs[best].tolist()
                found.append((x, y, k))
                todo += [(*part, level, _within(runs, *part, least)) for part in ((i, x, j, y), (x + k, m, y + k, n))]
                continue
        if area <= SMALL:
            found += [(i + x, j + y, k) for x, y, k in SequenceMatcher(None, a[i:m], b[j:n], autojunk=False).get_matching_blocks() if k]
            continue
        x, y, k = longest(a[i:m], b[j:n])
        if k:
            found.append((i + x, j + y, k))
            todo += [(i, i + x, j, j + y, level, None), (i + x + k, m, j + y + k, n, level, None)]
    out: list[tuple[int, int, int]] = []
    for i, j, k in sorted(found):
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1] = (*out[-1][:2], out[-1][2] + k)
        else:
            out.append((i, j, k))
    return out


def changed(a: str, b: str) -> tuple[float, list[tuple[int, int, int, int]]]:
    """Twice the equal characters by all of both (1 for empty texts), and the ranges between equal stretches."""
    blocks, out, at = matching_blocks(a, b), [], (0, 0)
    for i, j, k in [*blocks, (len(a), len(b), 0)]:
        if at != (i, j):
            out.append((at[0], i, at[1], j))
        at = (i + k, j + k)
    size = len(a) + len(b)
    return 2.0 * sum(k for _, _, k in blocks) / size if size else 1.0, out
