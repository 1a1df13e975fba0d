"""Suffix arrays by linear grouping construction, many texts in lockstep.

Phase one starts from groups of suffixes with equal first symbols and processes
groups in descending order.  For each suffix of the group the pointer to its
previous suffix in a smaller group is found by following pointers already set;
the suffixes pointed to are split from their groups, those with more pointers
first, and form new groups right above.  In the end a group holds the suffixes
with the same longest Lyndon prefix.  Phase two walks the suffix array from its
smallest entry and puts, for every entry, the suffix before it and the chain of
its previous-smaller pointers at the next free place of their groups.  No names
are assigned and nothing recurs.

The construction is sequential in one text, so a single text would cost one
interpreter step per symbol.  Here every step acts on one group of each of many
independent texts at once, as numpy operations over all of them.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import ragged


def index_kind(n: int) -> type:
    """The smaller integer that holds the positions of ``n`` symbols."""
    return np.int32 if n < 1 << 31 else np.int64


def suffix_arrays(symbols: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Suffix arrays of the texts symbols[base[t]:base[t + 1]], one after another
    (global positions).  The last symbol of each text is its unique smallest."""
    n, texts = len(symbols), len(base) - 1
    size = np.diff(base)
    kind = index_kind(n)
    text = np.repeat(np.arange(texts, dtype=kind), size)

    # groups: runs of `order`; a group is named by its first place
    order = np.lexsort((symbols, text)).astype(kind)
    new = np.ones(n, bool)
    for key in (symbols, text):
        key = key[order]
        new[1:] &= key[1:] == key[:-1]
    new[1:] = ~new[1:]
    del text, key
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, n))
    group = np.empty(n, kind)
    group[order] = np.repeat(starts.astype(kind), count)
    width = np.zeros(n, kind)
    width[starts] = count
    del new, starts, count
    place = np.empty(n, kind)
    place[order] = np.arange(n, dtype=kind)

    before = np.full(n, -1, kind)
    chosen = np.zeros(n, bool)
    live = np.flatnonzero(size > 0)
    end = base[1:][live] - 1
    low = base[:-1][live]
    while len(end):
        head = group[order[end]]
        count = end - head + 1
        members = order[ragged(head, count)] if count.max() > 1 else order[head]
        of_text = np.repeat(np.arange(len(end)), count) if count.max() > 1 else np.arange(len(end))
        limit, floor = head[of_text], low[of_text]
        at = members - 1
        at[at < floor] = -1
        before[members] = at
        open_ = np.flatnonzero(at >= 0)
        open_ = open_[group[at[open_]] >= limit[open_]]
        while len(open_):
            step = before[at[open_]]
            at[open_] = step
            before[members[open_]] = step
            open_ = open_[step >= 0]
            open_ = open_[group[at[open_]] >= limit[open_]]
        targets = at[at >= 0]
        if len(targets):
            if len(targets) == len(end) == len(members):
                _split(targets, order, place, group, width, chosen)   # one pointer in each text
            else:
                targets, times = np.unique(targets, return_counts=True)
                for k in range(int(times.max()), 0, -1):
                    same = targets[times == k]
                    if len(same):
                        _split(same, order, place, group, width, chosen)
        end = head - 1
        more = end >= low
        end, low = end[more], low[more]

    # emit each group's order
    del order, place, width, chosen
    out = np.full(n, -1, kind)
    slot = np.arange(n, dtype=kind)
    done = np.zeros(n, bool)
    live = np.flatnonzero(size > 0)
    i, low, high = base[:-1][live].copy(), base[:-1][live], base[1:][live]
    out[i] = high - 1
    done[high - 1] = True
    slot[group[high - 1]] += 1
    j = np.where(high - 2 >= low, high - 2, -1)
    while len(i):
        go = np.flatnonzero(j >= 0)
        go = go[~done[j[go]]]
        if len(go):
            x = j[go]
            g = group[x]
            out[slot[g]] = x
            slot[g] += 1
            done[x] = True
        wait = np.ones(len(i), bool)
        wait[go] = False
        if len(go):
            j[go] = before[x]
        stop = np.flatnonzero(wait)
        i[stop] += 1
        over = i[stop] >= high[stop]
        ok = stop[~over]
        nxt = out[i[ok]] - 1
        j[ok] = np.where(nxt >= low[ok], nxt, -1)
        if over.any():
            keep = np.ones(len(i), bool)
            keep[stop[over]] = False
            i, j, low, high = i[keep], j[keep], low[keep], high[keep]
    return out


def _split(moved, order, place, group, width, chosen) -> None:
    """Take the suffixes ``moved`` out of their groups into new groups right above."""
    g = group[moved]
    if len(moved) > 1:
        by = np.argsort(g, kind="stable")
        moved, g = moved[by], g[by]
        edge = np.ones(len(g), bool)
        edge[1:] = g[1:] != g[:-1]
        heads = g[edge]
        count = np.diff(np.append(np.flatnonzero(edge), len(g)))
    else:
        heads, count = g, np.ones(1, np.int64)
    size = width[heads]
    part = count < size
    if not part.any():
        return
    if not part.all():
        keep = np.repeat(part, count)
        moved, g, heads, count, size = moved[keep], g[keep], heads[part], count[part], size[part]
    fresh = heads + size - count
    tail = ragged(fresh, count)
    chosen[moved] = True
    held = order[tail]
    out = tail[~chosen[held]]                       # places of the tail that others hold
    if len(out):
        start = np.repeat(fresh, count)
        inner = place[moved]
        back = inner[inner < start]                 # places below the tail to give up, in group order
        a, b = order[out].copy(), order[back].copy()
        order[out], order[back] = b, a
        place[b], place[a] = out, back
    chosen[moved] = False
    group[moved] = np.repeat(fresh, count)
    width[heads] = size - count
    width[fresh] = count


def repeated_windows(symbols: np.ndarray, base: np.ndarray, suffixes: np.ndarray, length: int,
                     lead: int = 32) -> np.ndarray:
    """Whether the ``length`` symbols from each position also start elsewhere in
    its text: the common prefix with a neighbour in the suffix array is as long.

    Common prefixes are found in text order, where each is at least the last
    one less one, ``lead`` symbols at a time and for all texts at once."""
    n = len(symbols)
    left = np.full(n, -1, index_kind(n))
    left[suffixes[1:]] = suffixes[:-1]
    left[suffixes[base[:-1][np.diff(base) > 0]]] = -1
    padded = np.concatenate((symbols, np.zeros(lead, symbols.dtype)))
    view = np.lib.stride_tricks.sliding_window_view(padded, lead)
    repeat = np.zeros(n, bool)
    has = np.flatnonzero(np.diff(base) > 0)
    i, stop = base[:-1][has].copy(), base[1:][has]
    h = np.zeros(len(i), np.int64)
    while len(i):
        p = left[i]
        todo = (p >= 0) & (h < length)
        k = np.flatnonzero(todo)
        done = ~todo
        if len(k):
            differ = view[i[k] + h[k]] != view[p[k] + h[k]]
            same = np.where(differ.any(axis=1), differ.argmax(axis=1), lead)
            h[k] += same
            done[k] = (same < lead) | (h[k] >= length)
        full = done & (p >= 0) & (h >= length)
        repeat[i[full]] = True
        repeat[p[full]] = True
        h[done] = np.where(p[done] >= 0, np.maximum(np.minimum(h[done], length) - 1, 0), 0)
        i[done] += 1
        more = i < stop
        i, stop, h = i[more], stop[more], h[more]
    return repeat
