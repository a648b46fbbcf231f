"""Ring sequences in numpy: least rotations, ordered shingles and cyclic edit distance, many rings at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from annulet.functions.rings import least_rotation

#: Codes of letters, three bits each; letters outside the alphabet share one code and are told apart later.
_CODE = np.full(256, 5, np.uint64)
for _i, _c in enumerate(b"ACGTN"):
    _CODE[_c] = _i

_DIGITS = bytes.maketrans(b"ACGT", b"0123")
_QUADS = [bytes(b"ACGT"[i >> s & 3] for s in (6, 4, 2, 0)) for i in range(256)]

_TWO_BITS = np.zeros(256, np.uint32)
for _i, _c in enumerate(b"ACGT"):
    _TWO_BITS[_c] = _i

PAIRS_AT_ONCE = 2048
LETTERS_AT_ONCE = 1_000_000
TESTS_AT_ONCE = 1 << 20
CONTEXT = 8  # letters after a shingle that travel with it
ROUNDS = 8  # anchors of a pair that are tried before the pair is tested as a whole


def pack(s: bytes) -> bytes:
    """Four letters a byte after a 1; after a 0 the letters themselves, where there are others than ACGT."""
    if s.strip(b"ACGT") or s.translate(None, b"ACGT"):
        return b"\0" + s
    return b"\1" + int(s.translate(_DIGITS), 4).to_bytes((len(s) + 3) // 4, "big")


def unpack(p: bytes, n: int) -> bytes:
    return p[1:] if p[0] == 0 else b"".join(map(_QUADS.__getitem__, p[1:]))[-n:]


def edits(n: int | np.ndarray, percent: int = 6) -> int | np.ndarray:
    """How many edits a pair may have whose longer ring has n letters."""
    return n * percent // 100


def longest_partner(n: int | np.ndarray, percent: int = 6) -> int | np.ndarray:
    """The length of the longest ring that may be in a pair with one of n letters."""
    return n * 100 // (100 - percent)


def canonical(rings: list[bytes]) -> list[bytes]:
    """Every ring, none empty, turned to its least rotation."""
    if not rings:
        return []
    wrapped = [(s * (1 + 8 // len(s)) + s[:8])[: len(s) + 7] if len(s) < 8 else s + s[:7] for s in rings]
    data = np.frombuffer(b"".join(wrapped) + bytes(8), np.uint8).astype(np.uint64)
    code = data
    for width in (1, 2, 4):
        code = (code[:-width] << np.uint64(8 * width)) | code[width:]
    sizes = np.array([len(s) for s in rings])
    starts = np.concatenate([[0], np.cumsum(sizes + 7)])[:-1]
    valid = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    code = code[valid]
    first = np.cumsum(sizes) - sizes
    least = np.minimum.reduceat(code, first)
    at = np.flatnonzero(code == np.repeat(least, sizes))
    owner = np.searchsorted(first, at, "right") - 1
    lo, hi = np.searchsorted(owner, np.arange(len(rings))), np.searchsorted(owner, np.arange(len(rings)), "right")
    out = []
    for r, s in enumerate(rings):
        turn = int(at[lo[r]] - first[r]) if hi[r] - lo[r] == 1 else least_rotation(s)
        out.append(s[turn:] + s[:turn])
    return out


def _windows(rings: list[bytes], q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, ring and place of every window of q letters, going round."""
    wrapped = b"".join((s * (1 + q // len(s)) + s[:q])[: len(s) + q - 1] for s in rings)
    codes, have, total = _CODE[np.frombuffer(wrapped, np.uint8)], 1, 0
    out, shift = None, 0
    while total < q:  # q as a sum of powers of two
        if q & have:
            out = codes if out is None else (out[: codes.size - shift] << np.uint64(3 * have)) | codes[shift:][: out.size]
            total += have
            shift = total
        if total < q:
            codes = (codes[:-have] << np.uint64(3 * have)) | codes[have:]
            have *= 2
    sizes = np.array([len(s) for s in rings])
    starts = np.concatenate([[0], np.cumsum(sizes + q - 1)])[:-1]
    ring = np.repeat(np.arange(len(rings), dtype=np.int32), sizes)
    valid = np.arange(sizes.sum()) + ring * np.int64(q - 1)
    place = (valid - np.repeat(starts, sizes)).astype(np.int32)
    return out[valid], ring, place


def _mixed(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 32 bits without visible order."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x = x * np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


@lru_cache
def _lengths(percent: int, most: int) -> np.ndarray:
    """By the length of a pair's longer ring (the last entry for all above) the length of the shingles it is looked up by.

    Whatever the pair, either ring has room for one shingle more, side by side, than the pair may have edits.
    """
    n = np.arange(1, 4001)
    room = n // (edits(longest_partner(n, percent), percent) + 1)
    fits = np.array([room[b - edits(b, percent) - 1 : b].min() for b in n])
    fits = np.minimum.accumulate(fits[::-1])[::-1]
    steps = np.array(sorted({x for x in (1, 2, 4, 8, 12) if x < most} | {most}))
    return np.concatenate([[0], steps[np.maximum(np.searchsorted(steps, fits, "right") - 1, 0)]])


def shingle_length(n: np.ndarray, percent: int, most: int) -> np.ndarray:
    table = _lengths(percent, most)
    return table[np.minimum(n, table.size - 1)]


def _plain(codes: np.ndarray, q: int) -> np.ndarray:
    """Whether a shingle of q letters is not nearly a repeat of one, two or three letters."""
    ok = np.ones(codes.size, bool)
    for step in (1, 2, 3):
        if q - step > 3:
            x = (codes ^ (codes >> np.uint32(2 * step))) & np.uint32((1 << 2 * (q - step)) - 1)
            ok &= np.bitwise_count((x | (x >> np.uint32(1))) & np.uint32(0x55555555)) > 1
    return ok


def _apart(at: np.ndarray, ring: np.ndarray, sizes: np.ndarray, need: np.ndarray, q: int) -> np.ndarray:
    """For each ring whether its chosen windows (places ``at`` in rising order) hold ``need`` that don't overlap, going round."""
    first, last = np.searchsorted(ring, np.arange(sizes.size)), np.searchsorted(ring, np.arange(sizes.size), "right")
    after = np.append(np.searchsorted(at, at + q), at.size)
    good, live, held = np.zeros(sizes.size, bool), np.flatnonzero(first < last), 1
    now = first[live]
    limit = at[now] + sizes[live] - q
    while live.size:
        full = need[live] <= held
        good[live[full]] = True
        now, held = after[now], held + 1
        on = ~full & (now < last[live])
        on[on] = at[now[on]] <= limit[on]
        live, now, limit = live[on], now[on], limit[on]
    return good


def keys(rings: list[bytes], percent: int = 6, most: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """hash, ring, context of the shingles by which rings find their partners, by rising hash.

    All shingles have one order (a fixed one, nearly repetitive ones last). A ring takes its first shingles in this
    order, until those taken hold one more, side by side, than any pair of the ring may have edits. So of two rings
    of a pair, the one that stops first has a shingle that no edit touches, the other has it too and takes it as well.
    Cut at such shingles, a ring has more arcs than a pair has edits, so from one of the arcs on there are never
    more edits than arcs before: the shingle and its arc are whole, and the next CONTEXT letters, which reach into
    one more arc at most, hold no more than one edit. They are the context that both sides are compared by.
    """
    sizes = np.array([len(s) for s in rings], np.int64)
    need = edits(longest_partner(sizes, percent), percent) + 1
    low, high = shingle_length(sizes, percent, most), shingle_length(longest_partner(sizes, percent), percent, most)
    found = []
    for q in np.unique(_lengths(percent, most)):
        mine = np.flatnonzero((low <= q) & (q <= high) & (need > 1))
        if q and mine.size:
            found.append(_keys([rings[i] for i in mine], mine, sizes[mine], need[mine], int(q)))
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.uint16)
    h, ring, context = (np.concatenate(x) for x in zip(*found))
    order = np.argsort((h.astype(np.uint64) << np.uint64(32)) | ring.astype(np.uint64), kind="stable")
    h, ring, context = h[order], ring[order], context[order]
    # What a ring repeats is needed once (also if other contexts stand between: then it stays).
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (ring[1:] != ring[:-1]) | (context[1:] != context[:-1])])
    return h[new], ring[new], context[new]


def _keys(rings: list[bytes], names: np.ndarray, sizes: np.ndarray, need: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    more = max(q + CONTEXT, 16)
    letters = b"".join((s * (1 + more // len(s)) + s[:more])[: len(s) + more] for s in rings) + bytes(16)
    eight = _TWO_BITS[np.frombuffer(letters, np.uint8)]
    for width in (1, 2, 4):
        eight = (eight[:-width] << np.uint32(2 * width)) | eight[width:]
    codes = ((eight[:-8] << np.uint32(16)) | eight[8:]) >> np.uint32(32 - 2 * q)
    rank = _scrambled(codes) >> np.uint32(1)
    starts = np.concatenate([[0], np.cumsum(sizes + more)])[:-1]
    ends = starts + sizes
    whole = np.uint32((1 << 31) - 1)
    limit = np.zeros(len(rings), np.int64)  # up to which rank a ring takes its shingles

    def chosen(share: float, which: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, rings and ranks of windows of the rings ``which`` with ranks in this share of all."""
        at = np.flatnonzero(rank <= whole * min(share, 1.0)) if share < 1 else np.arange(rank.size)
        ring = np.searchsorted(starts, at, "right") - 1
        keep = at < ends[ring]
        if which is not None:
            keep &= which[ring]
        at, ring = at[keep], ring[keep]
        ranks = rank[at].astype(np.int64)
        ranks[~_plain(codes[at], q)] += 1 << 31  # they come last
        return at, ring, ranks

    share = 0.7 / max(float(np.median(sizes / need)) - q + 1, 1.0)
    at, ring, ranks = chosen(2.4 * share, None)
    taken = []
    for step in (share * 1.12**i for i in range(12)):
        cut = int(whole * min(step, 1.0))
        sub = (ranks <= cut) & (limit[ring] == 0)
        good = _apart(at[sub], ring[sub], sizes, need, q)
        limit[good] = cut
    done = limit > 0
    taken.append(ranks <= np.where(done, limit, -1)[ring])
    at, ring = [at[taken[0]]], [ring[taken[0]]]
    for cut in (int(whole), 1 << 32):
        left = limit == 0
        if left.any():
            at2, ring2, ranks2 = chosen(1.0, left)
            sub = ranks2 <= cut
            good = _apart(at2[sub], ring2[sub], sizes, need, q) if cut <= whole else left
            limit[good & left] = cut
            sub &= good[ring2]
            at.append(at2[sub]), ring.append(ring2[sub])
    at, ring = np.concatenate(at), np.concatenate(ring)
    h = _scrambled(codes[at] ^ np.uint32(q * 0x9E3779B1 & 0xFFFFFFFF)) ^ np.uint32(0x5BD1E995)
    return _scrambled(h), names[ring], eight[at + q].astype(np.uint16)


def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether contexts (eight letters of two bits) agree but for one edit, their ends being free."""
    x, y = x.astype(np.uint32), y.astype(np.uint32)

    def run(shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Mismatches with y moved left by ``shift`` letters, one bit pair a letter, the first letter highest."""
        z = x ^ ((y << np.uint32(2 * shift)) & np.uint32(0xFFFF)) if shift >= 0 else x ^ (y >> np.uint32(-2 * shift))
        return (z | (z >> np.uint32(1))) & np.uint32(0x5555), z

    def first(m: np.ndarray) -> np.ndarray:
        """How many letters agree from the start."""
        bits = np.where(m > 0, np.frexp(m.astype(np.float32))[1], 0)
        return np.where(m > 0, (16 - bits) // 2, 8)

    straight, _ = run(0)
    good = np.bitwise_count(straight) <= 1  # equal, or one replaced
    head = first(straight)
    rest = np.uint32(0xFFFF) >> (2 * head).astype(np.uint32)  # letters from the first difference on
    gone, _ = run(1)  # a letter of y left out: x[i] against y[i + 1], the last letter of x free
    good |= (gone & rest & ~np.uint32(3)) == 0
    came, _ = run(-1)  # a letter of x left out: x[i + 1] against y[i]
    good |= (came & (rest >> np.uint32(2))) == 0
    return good


def meeting(h: np.ndarray, n: np.ndarray, num: np.ndarray, context: np.ndarray, side: np.ndarray | None = None, percent: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """num pairs, each once, of rings that share a shingle, have fitting lengths and contexts, and are of both sides if there are two."""
    names, num = np.unique(num, return_inverse=True)
    num = num.astype(np.uint64)  # below 2**32, so two of them are one number
    key = (h.astype(np.uint64) << np.uint64(32)) | n.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    key, n, num, context = key[order], n[order], num[order], context[order]
    side = None if side is None else side[order]
    low = np.searchsorted(key, key - edits(n, percent).astype(np.uint64))
    count = np.arange(key.size) - low
    ends = np.cumsum(count)
    found, fresh, held = np.zeros(0, np.uint64), [], 0
    compared = (shingle_length(np.arange(percent, 4001), percent, CONTEXT)[edits(np.arange(percent, 4001), percent) > 0] >= CONTEXT).all()
    at = 0
    while at < key.size:  # some entries at a time; one entry with very many before it in blocks
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TESTS_AT_ONCE, "right")))
        for skip in range(0, int(count[at:stop].max()), TESTS_AT_ONCE):
            size = np.clip(count[at:stop] - skip, 0, TESTS_AT_ONCE)
            b = np.repeat(np.arange(at, stop), size)
            a = np.repeat(low[at:stop] + skip, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            ok = (num[a] != num[b]) if side is None else side[a] != side[b]
            a, b = a[ok], b[ok]
            ok = alike(context[a], context[b]) if compared else slice(None)  # shorter shingles may have more edits behind them
            a, b = num[a[ok]], num[b[ok]]
            fresh.append(np.unique((np.minimum(a, b) << np.uint64(32)) | np.maximum(a, b)))
            held += fresh[-1].size
            if held > max(TESTS_AT_ONCE, found.size):  # many rings that are alike meet again and again
                found, fresh, held = np.unique(np.concatenate([found, *fresh])), [], 0
        at = stop
    found = np.unique(np.concatenate([found, *fresh]))
    return names[(found >> np.uint64(32)).astype(np.int64)], names[(found & np.uint64(0xFFFFFFFF)).astype(np.int64)]


def profiles(rings: list[bytes], q: int = 4) -> np.ndarray:
    """How often each of the q-letter shingles occurs in each ring, hashed to 256 columns."""
    codes, ring, _ = _windows(rings, q)
    column = (_mixed(codes) & np.uint64(255)).astype(np.int64)
    return np.bincount(ring * 256 + column, minlength=256 * len(rings)).reshape(-1, 256).astype(np.int32)


def _shared(rings: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many shingles the rings of each pair have in common, counted as often as both have them."""
    if not a.size:
        return np.zeros(0, np.int64)
    named, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    counts = profiles([rings[i] for i in named])
    return np.minimum(counts[at[: a.size]], counts[at[a.size :]]).sum(axis=1)


def within(a: list[bytes], b: list[bytes], most: np.ndarray) -> np.ndarray:
    """For each i whether a[i] becomes b[i], which is not shorter, by at most most[i] edits; columns of a banded table, side by side."""
    na, nb = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    k = int(most.max(initial=0))
    rows, m = int(na.max(initial=0)), len(a)
    left = np.full((m, rows), 254, np.uint8)
    right = np.full((m, rows + 2 * k + 2), 255, np.uint8)
    for i, (s, t) in enumerate(zip(a, b)):
        left[i, : len(s)] = np.frombuffer(s, np.uint8)
        t = t[: rows + k + 2]
        right[i, k : k + len(t)] = np.frombuffer(t, np.uint8)
    left, right = np.ascontiguousarray(left.T), np.ascontiguousarray(right.T)
    far = np.int16(15000) if k + rows < 14000 else np.int32(1 << 29)
    shift = np.arange(2 * k + 1) - k
    cost = np.where(shift >= 0, np.maximum(shift, 0) - np.arange(2 * k + 1), far).astype(far.dtype)  # less the column, so that going right is free
    cost = np.repeat(cost[:, None], m, axis=1)
    good, live = np.zeros(m, bool), np.arange(m)
    for i in range(1, rows + 1):
        step = cost + (right[i - 1 : i + 2 * k] != left[i - 1])
        np.minimum(step[:-1], cost[1:] + far.dtype.type(2), out=step[:-1])
        cost = np.minimum.accumulate(step, axis=0)
        done = na[live] == i
        if done.any():
            column = nb[live] - na[live] + k
            value = cost[np.clip(column, 0, 2 * k), np.arange(live.size)] + column
            good[live[done]] = (value[done] <= most[live[done]]) & (column[done] <= 2 * k)
        if done.any() or i % 32 == 0:
            hope = ~done & ((cost + np.arange(2 * k + 1, dtype=cost.dtype)[:, None]).min(axis=0) <= most[live])
            if not hope.all():
                live, cost, left, right = live[hope], cost[:, hope], left[:, hope], right[:, hope]
                if not live.size:
                    break
    return good | ((na == 0) & (nb <= most))


def least_inside(pattern: bytes, text: bytes) -> int:
    """The fewest edits that make ``pattern`` a part of ``text``; columns of the table as bits of whole numbers."""
    m = len(pattern)
    where = {c: 0 for c in set(text)}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, cost = full, 0, m
    best = cost
    for c in text:
        eq = where[c]
        zero = ((((eq & up) + up) ^ up) | eq | down) & full
        plus, minus = (down | ~(zero | up)) & full, up & zero
        cost += 1 if plus & top else -1 if minus & top else 0
        best = min(best, cost)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = (minus | ~(zero | plus)) & full, plus & zero
    return best


def _anchored(a: list[bytes], b: list[bytes], most: np.ndarray, q: int) -> np.ndarray:
    """``close`` for pairs whose longer rings b are cut into pieces of q letters or more."""
    sizes = np.array([len(s) for s in b])
    codes, pair, place = _windows(a, q)
    key = codes * np.uint64(0x9E3779B97F4A7C15) ^ _scrambled(pair.astype(np.uint32)).astype(np.uint64) << np.uint64(31)
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    count = most + 1
    owner = np.repeat(np.arange(len(b)), count)
    b_at = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * sizes[owner] // count[owner]
    pieces = _windows(b, q)[0][(np.cumsum(sizes) - sizes)[owner] + b_at]
    pieces = pieces * np.uint64(0x9E3779B97F4A7C15) ^ _scrambled(owner.astype(np.uint32)).astype(np.uint64) << np.uint64(31)
    low, high = np.searchsorted(key, pieces), np.searchsorted(key, pieces, "right")
    ends = np.cumsum(high - low)
    first = np.concatenate([[0], ends])[np.cumsum(count) - count]  # a pair's anchors, of all its pieces in a row
    last = ends[np.cumsum(count) - 1]
    good, live, nth = np.zeros(len(b), bool), np.arange(len(b)), 0
    while (live := live[first[live] + nth < last[live]]).size:
        for at in range(0, live.size, PAIRS_AT_ONCE):
            some = live[at : at + PAIRS_AT_ONCE]
            piece = np.searchsorted(ends, first[some] + nth, "right")
            a_at = place[low[piece] + first[some] + nth - (ends - (high - low))[piece]]
            turn = lambda r, p: r[p:] + r[:p]
            good[some] = within([turn(a[i], p) for i, p in zip(some, a_at)], [turn(b[i], p) for i, p in zip(some, b_at[piece])], most[some])
        live, nth = live[~good[live]], nth + 1
        if nth == ROUNDS:  # a turned ring is a part of the ring written twice
            live = np.array([i for i in live if least_inside(b[i], a[i] + a[i]) <= most[i]], np.int64)
    return good


def close(a: list[bytes], b: list[bytes], percent: int = 6) -> np.ndarray:
    """For each pair of rings whether a rotation and at most ``percent`` % edits of the longer one make them equal."""
    turned = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    good = np.array([len(x) == len(y) and y in x + x for x, y in turned], bool)
    sizes = np.array([[len(x), len(y)] for x, y in turned], np.int64).reshape(-1, 2)
    most = edits(sizes[:, 1], percent)
    live = np.flatnonzero(~good & (most > 0) & (sizes[:, 1] - sizes[:, 0] <= most))
    names: dict[bytes, int] = {}
    at = np.array([[names.setdefault(s, len(names)) for s in turned[i]] for i in live], np.int64).reshape(-1, 2)
    rings = list(names)
    # An edit touches at most four shingles of four letters: a bound on the Jaccard distance of the multisets.
    shared = [np.zeros(0, np.int64)] + [_shared(rings, at[h, 0], at[h, 1]) for h in np.array_split(np.arange(live.size), live.size // 4096 + 1)]
    live = live[np.concatenate(shared) >= sizes[live, 1] - 4 * most[live]]
    q = np.minimum(16, sizes[live, 1] // (most[live] + 1))
    for length in np.unique(q):
        same = live[q == length]
        same = same[np.argsort(sizes[same, 1], kind="stable")]
        for some in np.split(same, np.flatnonzero(np.diff(np.cumsum(sizes[same, 1]) // LETTERS_AT_ONCE)) + 1):
            good[some] = _anchored([turned[i][0] for i in some], [turned[i][1] for i in some], most[some], int(length))
    return good
