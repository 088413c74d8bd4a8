"""Similarity in plain Python, for the few measures that no built-in expresses; used through Arrow UDFs."""

from __future__ import annotations

import difflib

import numpy as np


def _bit_columns(a, b, free_start: bool):
    """Distances of `a` to the prefixes of `b` (or, with a free start, to their best suffixes): a column of the table as bits of two integers."""
    m = len(a)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    where: dict = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score = mask, 0, m
    for c in b:
        eq = where.get(c, 0)
        v = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (~(h | up) & mask), up & h
        score += bool(plus & top) - bool(minus & top)
        plus = ((plus << 1) | (not free_start)) & mask
        minus = (minus << 1) & mask
        up, down = minus | (~(v | plus) & mask), plus & v
        yield score


def edit_distance(a, b) -> int:
    """Levenshtein distance of two strings or sequences (bit-parallel)."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    score = len(a)
    for score in _bit_columns(a, b, False):
        pass
    return score


def ned(a: str, b: str) -> float:
    n = max(len(a), len(b))
    return edit_distance(a, b) / n if n else 0.0


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least-cost matching of rows to columns (shortest augmenting paths with potentials)."""
    if cost.size == 0:
        return []
    flip = cost.shape[0] > cost.shape[1]
    c = cost.T if flip else cost
    n, m = c.shape
    u, v = np.zeros(n + 1), np.zeros(m + 1)
    row_of, way = np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        row_of[0], j0 = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = row_of[j0]
            free = ~used[1:]
            reduced = c[i0 - 1] - u[i0] - v[1:]
            better = free & (reduced < least[1:])
            least[1:][better] = reduced[better]
            way[1:][better] = j0
            j1 = int(np.argmin(np.where(free, least[1:], np.inf))) + 1
            delta = least[j1]
            u[row_of[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if row_of[j0] == 0:
                break
        while j0:
            row_of[j0] = row_of[way[j0]]
            j0 = way[j0]
    pairs = [(int(row_of[j]) - 1, j - 1) for j in range(1, m + 1) if row_of[j]]
    return sorted((b, a) if flip else (a, b) for a, b in pairs)


def window_ned(small: str, large: str) -> float:
    """Best normalised distance of `small` to a substring of `large` (free start and end), over the length of `small`."""
    return near_substring(small, large) / len(small) if small else 0.0


def near_substring(needle: str, text: str) -> int:
    """Least number of edits that make `needle` a substring of `text`."""
    return min([len(needle), *_bit_columns(needle, text, True)]) if needle else 0


#: Largest accepted distance, rescue distance and its size limit, and the number of cells from which the whole text is compared.
ACCEPT, RESCUE, RESCUE_CHARS, CELLS = 0.70, 0.40, 2000, 400_000


def block_match(ref: list[str], hyp: list[str]) -> dict:
    """Blocks matched one to one by least normalised distance: nid = 1 - edits / characters, unmatched blocks count whole."""
    if not ref or not hyp or len(ref) * len(hyp) > CELLS:
        a, b = "\n\n".join(ref), "\n\n".join(hyp)
        return {"nid": 1 - ned(a, b) if a or b else 1.0, "matched": 0, "order": 0.0, "whole_text": True}
    cost = np.ones((len(ref), len(hyp)))
    for i, a in enumerate(ref):
        for j, b in enumerate(hyp):
            n = max(len(a), len(b), 1)
            cost[i, j] = 1.0 if abs(len(a) - len(b)) / n > ACCEPT else ned(a, b)
    pairs = [(i, j) for i, j in assignment(cost) if cost[i, j] <= ACCEPT]
    left = [j for j in range(len(hyp)) if j not in {q for _, q in pairs}]
    for i in [i for i in range(len(ref)) if i not in {p for p, _ in pairs}]:
        best = min(((window_ned(hyp[j], ref[i]), j) for j in left if 0 < len(hyp[j]) <= RESCUE_CHARS), default=(1.0, -1))
        if best[0] < RESCUE:
            pairs.append((i, best[1]))
            left.remove(best[1])
    pairs.sort()
    edits = sum(edit_distance(ref[i], hyp[j]) for i, j in pairs)
    seen_i, seen_j = {i for i, _ in pairs}, {j for _, j in pairs}
    lost = sum(len(x) for i, x in enumerate(ref) if i not in seen_i) + sum(len(x) for j, x in enumerate(hyp) if j not in seen_j)
    length = sum(max(len(ref[i]), len(hyp[j])) for i, j in pairs) + lost
    order = [j for _, j in pairs]
    return {"nid": 1 - (edits + lost) / length if length else 1.0, "matched": len(pairs), "order": edit_distance(order, sorted(order)) / len(order) if order else 0.0, "whole_text": False}


def tree_distance(a: tuple, b: tuple, rename=lambda x, y: float(x != y)) -> float:
    """Ordered tree edit distance (Zhang and Shasha) of (label, [children]) trees."""

    def flat(t):
        labels, left = [], []

        def walk(node):
            first = None
            for k in node[1]:
                l = walk(k)  # noqa: E741
                first = l if first is None else first
            labels.append(node[0])
            left.append(len(labels) - 1 if first is None else first)
            return left[-1]

        walk(t)
        keys = sorted({l: i for i, l in enumerate(left)}.values())
        return labels, left, keys

    la, fa, ka = flat(a)
    lb, fb, kb = flat(b)
    td = np.zeros((len(la), len(lb)))
    for i in ka:
        for j in kb:
            m, n = i - fa[i] + 2, j - fb[j] + 2
            fd = np.zeros((m, n))
            fd[1:, 0] = np.arange(1, m)
            fd[0, 1:] = np.arange(1, n)
            for x in range(1, m):
                for y in range(1, n):
                    p, q = fa[i] + x - 1, fb[j] + y - 1
                    if fa[p] == fa[i] and fb[q] == fb[j]:
                        fd[x, y] = min(fd[x - 1, y] + 1, fd[x, y - 1] + 1, fd[x - 1, y - 1] + rename(la[p], lb[q]))
                        td[p, q] = fd[x, y]
                    else:
                        fd[x, y] = min(fd[x - 1, y] + 1, fd[x, y - 1] + 1, fd[fa[p] - fa[i], fb[q] - fb[j]] + td[p, q])
    return float(td[-1, -1])


def tree_size(t: tuple) -> int:
    return 1 + sum(tree_size(k) for k in t[1])


def tree_similarity(a: tuple, b: tuple, rename=lambda x, y: float(x != y)) -> float:
    return 1 - tree_distance(a, b, rename) / max(tree_size(a), tree_size(b))


def table_tree(grid: list[list[str]]) -> tuple:
    return ("table", [("tr", [("td:" + c, []) for c in row]) for row in grid])


def table_similarity(a: list[list[str]], b: list[list[str]], structure_only: bool = False) -> float:
    def rename(x, y):
        if x.startswith("td:") and y.startswith("td:"):
            return 0.0 if structure_only else ned(x[3:], y[3:])
        return float(x != y)

    return tree_similarity(table_tree(a), table_tree(b), rename)


def heading_tree(levels: list[int], titles: list[str]) -> tuple:
    root: tuple = ("", [])
    stack = [(0, root)]
    for level, title in zip(levels, titles):
        while len(stack) > 1 and stack[-1][0] >= level:
            stack.pop()
        node: tuple = (title, [])
        stack[-1][1][1].append(node)
        stack.append((level, node))
    return root


def ratio(a: str, b: str) -> float:
    return difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()


def symmetric_ratio(a: str, b: str) -> float:
    return max(ratio(a, b), ratio(b, a))


def aligned(a: list[str], b: list[str]) -> list[tuple[str, int, int, int, int]]:
    """Opcodes that turn a into b."""
    return difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
