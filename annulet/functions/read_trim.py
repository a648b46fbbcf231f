"""The hits of one read: tandem copies of a pattern of places, or hits merged along the read.

These rules are sequential (what is kept decides about what comes next), so they run on the hits of one read at a
time; everything before and after is relational.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, replace
from functools import reduce

NEAR = 50
_BASE, _MOD = 1_000_003, (1 << 61) - 1


@dataclass(frozen=True, slots=True)
class Hit:
    q_start: int
    q_end: int
    ref: str
    r_start: int
    r_end: int
    match: int
    block: int
    mapq: int
    strand: int


def tokens(hits: list[Hit]) -> list[tuple[int, int]]:
    """(place, strand) per hit; a hit whose ends both lie near those of an earlier place on the same sequence has that place."""
    seen: dict[tuple[str, int, int], list[tuple[int, int, int]]] = {}
    out, count = [], 0
    for h in hits:
        a, b = h.r_start // (NEAR + 1), h.r_end // (NEAR + 1)
        near = [
            p for da in (-1, 0, 1) for db in (-1, 0, 1) for p in seen.get((h.ref, a + da, b + db), ()) if abs(p[1] - h.r_start) <= NEAR and abs(p[2] - h.r_end) <= NEAR
        ]
        if near:
            place = min(near)[0]
        else:
            place, count = count, count + 1
            seen.setdefault((h.ref, a, b), []).append((place, h.r_start, h.r_end))
        out.append((place, h.strand))
    return out


def pattern(order: list) -> list:
    """The repeated run of tokens, empty if no token repeats: the commonest chunk of the largest chunk size that repeats one."""
    counts = Counter(order)
    if not order or counts.most_common(1)[0][1] < 2:
        return []
    if len(counts) == 1:
        return [order[0]]
    rest = order[order.index(counts.most_common(1)[0][0]) :]
    if len(set(rest)) == 1:
        return [rest[0]]
    sums, power = [0], [1]  # hashes of all prefixes, so that a chunk costs the same at every size
    codes = {t: i + 1 for i, t in enumerate(dict.fromkeys(rest))}
    for t in rest:
        sums.append((sums[-1] * _BASE + codes[t]) % _MOD)
        power.append(power[-1] * _BASE % _MOD)
    for size in range(len(rest) // 2, 0, -1):
        chunks = Counter((sums[i + size] - sums[i] * power[size]) % _MOD for i in range(0, len(rest) - size + 1, size))
        code, n = chunks.most_common(1)[0]
        if n > 1:
            at = next(i for i in range(0, len(rest) - size + 1, size) if (sums[i + size] - sums[i] * power[size]) % _MOD == code)
            return rest[at : at + size]
    return []


def longest_run(order: list, part: list) -> range:
    """Places of the longest stretch of back-to-back copies of ``part``, the first of equals."""
    best, i, n = range(0), 0, len(part)
    while part and i + n <= len(order):
        j = i
        while order[j : j + n] == part:
            j += n
        if j - i > len(best):
            best = range(i, j)
        i = max(j, i + 1)
    return best


#: How a field of two hits becomes one; every other field is the later hit's.
FUSED = {"q_start": min, "r_start": min, "q_end": max, "r_end": max, "match": max, "block": max, "mapq": max}

#: What becomes of a hit, by how far it starts behind the end of the last kept one (rows: by ``overlap`` or more before
#: it, up to it, within the gap, further) and by where both lie (columns: near on one strand, far on one strand, elsewhere).
DECISIONS = (("fuse", "keep", "longer"), ("keep", "keep", "keep"), ("fuse", "keep", "keep"), ("drop", "drop", "drop"))


def merged(hits: list[Hit], gap: int = 10, overlap: int = 10, distance: int = 1000) -> list[Hit]:
    """Hits in query order, folded by the table of decisions."""
    limits = (-overlap, 0, gap)

    def fold(kept: list[Hit], hit: Hit) -> list[Hit]:
        if not kept:
            return [hit]
        last = kept[-1]
        where = 2 if (last.ref, last.strand) != (hit.ref, hit.strand) else int(abs(last.r_end - hit.r_start) > distance)
        match DECISIONS[bisect_left(limits, hit.q_start - last.q_end)][where]:
            case "fuse":
                kept[-1] = replace(hit, **{f: pick(getattr(last, f), getattr(hit, f)) for f, pick in FUSED.items()})
            case "longer":
                kept[-1] = max(last, hit, key=lambda x: x.q_end - x.q_start)
            case "keep":
                kept.append(hit)
        return kept

    return reduce(fold, hits, [])


def trimmed(hits: list[Hit], gap: int = 10, overlap: int = 10, distance: int = 1000) -> tuple[list[Hit], int, bool]:
    """Of hits in query order the kept ones, the stretch of the read from the first to the last, and whether they are tandem copies."""
    if len(hits) > 1:
        order = tokens(hits)
        part = pattern(order)
        run = longest_run(order, part)
        if len(run) > len(part):
            chosen = [hits[i] for i in run]
            return chosen, chosen[-1].q_end - chosen[0].q_start, True
    kept = merged(hits, gap, overlap, distance)
    return kept, kept[-1].q_end - kept[0].q_start if kept else 0, False


def reversed_strands(t: str) -> str:
    return t.translate(str.maketrans("+-", "-+"))


def _cycle(nodes: list[str], links: dict[str, set[str]]) -> list[str]:
    """Nodes of a simple cycle in walking order, smaller neighbours first; empty if there is none."""
    parent: dict[str, str | None] = {}
    for root in nodes:
        if root in parent:
            continue
        parent[root] = None
        stack = [(root, iter(sorted(links.get(root, ()))))]
        on_path = {root: 0}
        while stack:
            node, rest = stack[-1]
            step = next(rest, None)
            if step is None:
                stack.pop()
                on_path.pop(node)
            elif step in on_path and step != parent[node]:
                return [n for n, _ in stack[on_path[step] :]]
            elif step not in parent:
                parent[step] = node
                on_path[step] = len(stack)
                stack.append((step, iter(sorted(links.get(step, ())))))
    return []


def resolved(nodes: list[str], transitions: dict[tuple[str, str], list[str]], strand: dict[str, str]) -> tuple[list[str], bool, bool, bool]:
    """Regions with strands along the circle, whether no node has more than two links, a loop, and whether it is circular."""
    nodes = sorted(nodes)
    plain = [f"{n}_{strand.get(n, '+')}" for n in nodes]
    pairs = [k for k in transitions if k[0] != k[1]]
    loop = len(pairs) < len(transitions)
    links: dict[str, set[str]] = {}
    for a, b in pairs:
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    degree = Counter(n for k in pairs for n in k)
    solved = len(nodes) < 2 or all(degree[n] <= 2 for n in nodes)
    first = lambda k: min(transitions[k])
    if len(nodes) == 1:
        key = (nodes[0], nodes[0])
        return ([f"{nodes[0]}_{first(key)[0]}"] if key in transitions else plain), solved, loop, loop
    if len(nodes) == 2:
        a, b = nodes
        mirrored = any(f.split("_") == r.split("_")[::-1] for f in transitions.get((a, b), ()) for r in transitions.get((b, a), ()))
        if (a, b) in transitions:
            plain = [f"{n}_{s}" for n, s in zip(nodes, first((a, b)).split("_"))]
        elif (b, a) in transitions:
            plain = [f"{n}_{s}" for n, s in zip(nodes, first((b, a)).split("_")[::-1])]
        return plain, solved, loop, solved and mirrored
    walk = _cycle(nodes, links)
    paths: list[list[str]] = []
    for a, b in zip(walk, walk[1:]):
        steps = sorted(transitions.get((a, b)) or [reversed_strands(t) for t in transitions.get((b, a), ())])
        ends = [[f"{n}_{s}" for n, s in zip((a, b), t.split("_"))] for t in steps]
        if not paths:
            paths = ends
        else:
            for x, y in ends:
                for p in paths:
                    if p[-1] == x:
                        p.append(y)
    return (max(paths, key=len) if paths else plain), solved, loop, solved and bool(walk)
