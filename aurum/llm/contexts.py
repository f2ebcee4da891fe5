"""Byte contexts of at most ``ORDER`` bytes, as sorted arrays of (context, symbol).

A coded symbol and the ``ORDER`` bytes before it are one number, a gram: the
nearest byte highest, then the farther ones, the symbol lowest.  The context of
order k is a gram's k highest bytes, an arc of order k that context and the
symbol.  The longest order counts occurrences; a shorter one counts the
different arcs of the next longer order (update exclusion).  A symbol that its
context has not seen escapes to the next shorter order, one order at a time,
where the symbols of the longer context are excluded; after order 0 the
symbols left are alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of the longest context, and of the longest one that all blocks share.
ORDER, SHARED = 6, 2
#: Classes of nodes for the estimation of escapes.
STATES = (ORDER + 1) * 8 * 64 * 16
_SYMBOL = np.uint64(255)


def mask(k: int) -> np.uint64:
    """The bits of a gram that are its context of order ``k``."""
    return np.uint64(((1 << 8 * k) - 1) << 8 * (ORDER + 1 - k))


def grams(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Grams of the coded symbols of texts that lie one behind another, each of
    ``sizes`` symbols behind ``ORDER`` bytes that aren't coded."""
    out = data.astype(np.uint64)
    for j in range(1, ORDER + 1):
        out[j:] |= data[:-j].astype(np.uint64) << np.uint64(8 * (ORDER + 1 - j))
    coded = np.ones(len(data), bool)
    starts = np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]]).astype(np.int64)
    coded[(starts[:, None] + np.arange(ORDER)).ravel()] = False
    return out[coded]


def blocks_of(keys: np.ndarray, blocks: int, hot: dict[int, np.ndarray]) -> np.ndarray:
    """The block of each gram, by its context of order SHARED + 1; grams of a hot
    context are dealt by one byte more, as long as that one is hot as well."""
    own = keys & mask(SHARED + 1)
    left = np.arange(len(keys))
    for k in range(SHARED + 1, ORDER):
        left = left[is_hot(keys[left] & mask(k), k, hot)]
        own[left] = keys[left] & mask(k + 1)
    x = own * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) % np.uint64(blocks)).astype(np.int32)


def is_hot(context: np.ndarray, k: int, hot: dict[int, np.ndarray]) -> np.ndarray:
    some = hot.get(k)
    if some is None or not len(some):
        return np.zeros(len(context), bool)
    return some[np.minimum(np.searchsorted(some, context), len(some) - 1)] == context


def pack_bytes(b: bytes) -> bytes:
    return len(b).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(b, asbytes=True)


def unpack_bytes(b: bytes) -> bytes:
    return pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True)


def pack(a: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    return pack_bytes(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes())


def unpack(b: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(unpack_bytes(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_values(a: np.ndarray) -> bytes:
    """Numbers that repeat: the different ones, and the place of each among them."""
    values, at = np.unique(a, return_inverse=True)
    head = pack(values)
    return len(head).to_bytes(8, "little") + head + pack(at.astype("<u4"))


def unpack_values(b: bytes, kind: str) -> np.ndarray:
    cut = 8 + int.from_bytes(b[:8], "little")
    return unpack(b[8:cut], kind)[unpack(b[cut:], "<u4")]


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted grams by their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0))) if len(keys) else pack_bytes(b"")


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, "<u8"), dtype=np.uint64)


def _class(x: np.ndarray) -> np.ndarray:
    """Itself up to 4, then by its number of bits."""
    x = np.asarray(x, np.int64)
    return np.where(x <= 4, x, np.floor(np.log2(np.maximum(x, 1))).astype(np.int64) + 3)


def since_blank(k: int, context: np.ndarray) -> np.ndarray:
    """Bytes of a context behind its last blank or start of text, ``k`` without one."""
    out = np.full(len(context), k)
    for j in range(k, 0, -1):
        byte = (context >> np.uint64(8 * (ORDER + 1 - j))) & _SYMBOL
        out[(byte == 32) | (byte == 9)] = j - 1
    return out


def state(k: int, place: np.ndarray, total: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Class of contexts: their order, place in a word, occurrences and different symbols."""
    return ((k * 8 + place) * 64 + np.minimum(_class(total), 63)) * 16 + np.minimum(_class(distinct), 15)


class Order:
    """All contexts of one order: their arcs (sorted) with counts, and what they exclude."""

    def __init__(self, k: int, arcs: np.ndarray, n: np.ndarray):
        self.k, self.arcs, self.n = k, arcs, n.astype(np.int64)
        context = arcs & mask(k)
        self.first = np.flatnonzero(np.concatenate([[len(arcs) > 0], context[1:] != context[:-1]])) if len(arcs) else np.empty(0, np.int64)
        self.context = context[self.first]
        self.total = np.add.reduceat(self.n, self.first) if len(arcs) else np.empty(0, np.int64)
        self.distinct = np.diff(np.append(self.first, len(arcs)))
        self.place = since_blank(k, self.context)
        self.below = np.zeros(len(self.first), np.int64)

    def shorter(self) -> tuple[np.ndarray, np.ndarray]:
        """Arcs of the next shorter order, and by how many of these they are seen."""
        return np.unique(self.arcs & (mask(self.k - 1) | _SYMBOL), return_counts=True)

    def exclude_from(self, low: Order) -> None:
        """Counts in the next shorter order of the symbols that each context has seen."""
        if len(self.arcs):
            n = low.n[np.searchsorted(low.arcs, self.arcs & (mask(low.k) | _SYMBOL))]
            self.below = np.add.reduceat(n, self.first)

    def left_out(self) -> tuple[np.ndarray, np.ndarray]:
        """By state: occurrences that, left out, would have been new, and those that would not."""
        if not len(self.arcs):
            return np.zeros(STATES, np.int64), np.zeros(STATES, np.int64)
        ones = np.add.reduceat((self.n == 1).astype(np.int64), self.first)
        many = self.total > 1
        w, t, d, ones = self.place[many], self.total[many], self.distinct[many], ones[many]
        new = np.bincount(state(self.k, w, t - 1, np.maximum(d - 1, 1)), ones, STATES)
        old = np.bincount(state(self.k, w, t - 1, d), t - ones, STATES)
        return new.astype(np.int64), old.astype(np.int64)


def chain(k: int, arcs: np.ndarray, n: np.ndarray, least: int) -> list[Order]:
    """The orders from ``k`` down to ``least``, longest first, without the exclusions in what is below."""
    out = [Order(k, arcs, n)]
    while out[-1].k > least:
        low = Order(out[-1].k - 1, *out[-1].shorter())
        out[-1].exclude_from(low)
        out.append(low)
    return out


#: Arcs with counts, by order.
Arcs = dict[int, tuple[np.ndarray, np.ndarray]]


def block_arcs(arcs: np.ndarray, n: np.ndarray, hot: dict[int, np.ndarray]) -> tuple[Arcs, Arcs]:
    """What a block with the arcs of order ORDER ``arcs`` holds: the arcs of its own
    contexts, whole, and its part of the arcs of contexts that several blocks
    share (hot ones, and all of order SHARED)."""
    own, part = {ORDER: (arcs, n)}, {}
    for k in range(ORDER - 1, SHARED - 1, -1):
        low, seen = np.unique(arcs & (mask(k) | _SYMBOL), return_counts=True)
        split = is_hot(low & mask(k), k, hot) if k > SHARED else np.ones(len(low), bool)
        part[k] = low[split], seen[split]
        arcs = low[~split]
        if k > SHARED:
            own[k] = arcs, seen[~split]
    return own, part


def different(a: np.ndarray) -> np.ndarray:
    """Different numbers, sorted (a sort: ``np.unique`` may hash them, which takes several times longer)."""
    a = np.sort(a)
    return a[np.concatenate([[True], a[1:] != a[:-1]])] if len(a) else a


def added(*some: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different arcs of all, sorted, with the sums of their counts."""
    arcs = np.concatenate([a for a, _ in some] or [np.empty(0, np.uint64)])
    n = np.concatenate([c for _, c in some] or [np.empty(0, np.int64)])
    order = np.argsort(arcs, kind="stable")  # of sorted runs
    arcs, n = arcs[order], n[order].astype(np.int64)
    if not len(arcs):
        return arcs, n
    first = np.flatnonzero(np.concatenate([[True], arcs[1:] != arcs[:-1]]))
    return arcs[first], np.add.reduceat(n, first)


class Model:
    """The shared contexts and the escapes.

    ``part``: arcs of the hot contexts and of order SHARED, as the sums of the
    blocks' parts.  A hot arc counts once in the next shorter order, which is
    shared as well."""

    def __init__(self, part: Arcs, new: np.ndarray, old: np.ndarray):
        self.hot: dict[int, Order] = {}
        none = np.empty(0, np.uint64), np.empty(0, np.int64)
        arcs = none[0]
        for k in range(ORDER - 1, SHARED, -1):
            longer = np.unique(arcs & (mask(k) | _SYMBOL), return_counts=True)
            arcs, n = added(part.get(k, none), longer)
            self.hot[k] = Order(k, arcs, n)
        longer = np.unique(arcs & (mask(SHARED) | _SYMBOL), return_counts=True)
        self.orders = chain(SHARED, *added(part.get(SHARED, none), longer), 0)
        for o in [*self.hot.values(), *self.orders]:
            more = o.left_out()
            new, old = new + more[0], old + more[1]
        self.states = np.where(new + old > 0, (new + 0.5) / (new + old + 1.0), -1.0)

    def complete(self, keys: np.ndarray, own: Arcs) -> list[Order]:
        """The orders above SHARED for some grams, longest first: a block's own
        contexts, and those hot ones that the grams have."""
        out = []
        for k in range(ORDER, SHARED, -1):
            arcs, n = own[k]
            if k in self.hot and len(self.hot[k].arcs):
                hot = self.hot[k]
                asked = different(keys & mask(k))
                at = np.minimum(np.searchsorted(asked, hot.arcs & mask(k)), max(0, len(asked) - 1))
                some = (asked[at] == hot.arcs & mask(k)) if len(asked) else np.zeros(len(hot.arcs), bool)
                arcs, n = added((arcs, n), (hot.arcs[some], hot.n[some]))
            out.append(Order(k, arcs, n))
        for high, low in zip(out, [*out[1:], self.orders[0]], strict=True):
            high.exclude_from(low)
        return out

    def escape(self, o: Order) -> np.ndarray:
        """Of each context of an order."""
        got = self.states[state(o.k, o.place, o.total, o.distinct)]
        return np.where(got < 0, o.distinct / (o.total + o.distinct), got)

    def log10(self, keys: np.ndarray, own: Arcs) -> np.ndarray:
        """log10 of grams whose contexts of more than SHARED bytes are in ``own`` or hot."""
        out, active, gone = np.zeros(len(keys)), np.arange(len(keys)), np.zeros(len(keys), np.int64)
        for o in [*self.complete(keys, own), *self.orders]:
            if not len(o.arcs) or not len(active):
                continue
            q = keys[active]
            context, arc = q & mask(o.k), q & (mask(o.k) | _SYMBOL)
            at = np.minimum(np.searchsorted(o.context, context), len(o.context) - 1)
            known = o.context[at] == context
            i = np.minimum(np.searchsorted(o.arcs, arc), len(o.arcs) - 1)
            hit = o.arcs[i] == arc
            t = o.total[at].astype(float)
            esc = self.escape(o)[at]
            whole = (1 - esc) * (t - gone) + esc * t  # of the symbols that aren't excluded
            step = np.where(hit, (1 - esc) * o.n[i], esc * t)
            out[active[known]] += np.log10(step[known] / whole[known])
            gone = np.where(known, o.below[at], 0)[~hit]
            active = active[~hit]
        out[active] -= np.log10(256.0 - len(self.orders[-1].arcs))
        return out
