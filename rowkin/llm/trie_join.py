"""Trie join: all pairs of words within a bounded edit distance.

Two words within k edits share one of the k + 1 segments of the longer one, so words are sharded by (length, segment, its
letters), and a word looks only into the shards of its own pieces: what a shard holds and who asks it follow from the words,
and no word is sent everywhere.  The shards of a task form one forest of tries held in arrays, one level per letter.  A batch of
query words goes down together: the frontier holds a (query, node, automaton state) triple per row, the state being the
banded row of the Levenshtein automaton with neighbour swaps; a row dies when its state can no longer accept.  Prefixes shared
by words are visited once per query, and numpy advances the whole frontier at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash

FAR = 99


def segments(m: int, k: int) -> list[tuple[int, int]]:
    """Begin and length of the k + 1 segments of a word of m letters, the longer ones last."""
    q, r = divmod(m, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = q + (i >= k + 1 - r)
        out.append((at, size))
        at += size
    return out


def _key(k: int, m: int, i: int, piece: str) -> int:
    """63 bits for a shard; the last one tells shards of the last segment, whose words are read from their end."""
    return (xxhash.xxh64_intdigest(f"{k},{m},{i},{piece}") >> 2 << 1) | (i == k)


def held_in(word: str, reach: Callable[[int], int]) -> set[int]:
    """Shards that hold a word, for all shorter or equally long words that may ask for it."""
    m = len(word)
    ks = {k for n in range(max(1, m - 2), m + 1) if (k := reach(n)) and n + k >= m}
    return {_key(k, m, i, word[p : p + size]) for k in ks for i, (p, size) in enumerate(segments(m, k))}


def _swapped(word: str, at: int) -> str:
    return word[: at - 1] + word[at] + word[at - 1] + word[at + 1 :] if 0 < at < len(word) else word


def asked_in(word: str, reach: Callable[[int], int]) -> set[int]:
    """Shards of at least as long words that may hold a neighbour of ``word``; for up to two edits.

    A segment left whole by the edits lies at most so far off its place as edits can stand on either side of it.  A swap of
    neighbours across the border of two segments touches both, so the word is also asked with such a swap undone.
    """
    n, k = len(word), reach(len(word))
    out = set()
    for m in range(n, n + k + 1) if k else ():
        cut = segments(m, k)
        for i, (p, size) in enumerate(cut):
            lo, hi = max(p - i, p + n - m - (k - i), 0), min(p + i, p + n - m + (k - i), n - size)
            out |= {_key(k, m, i, word[s : s + size]) for s in range(lo, hi + 1)}
        if m == n or (m == n + 1 and k == 2):  # more letters leave no edit for a swap
            out.add(_key(k, m, 0, _swapped(word, cut[1][0])[: cut[0][1]]))
            if k == 2:
                p, size = cut[2]
                out.add(_key(k, m, 2, _swapped(word, p + n - m)[p + n - m : p + n - m + size]))
    return out


def _matrix(words: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(words), width), dtype=np.uint32)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out


class Trie:
    """A forest, one tree per shard, in levels of nodes: letter, range of children in the next level, and the word that ends here
    or -1.  ``words`` are in order of (shard, word) and distinct within a shard; the words of a shard are of one length."""

    def __init__(self, words: list[str], shard: np.ndarray):
        n, size = len(words), int(shard.max(initial=-1)) + 1
        lens = np.array([len(w) for w in words], dtype=np.int64)
        self.length = np.zeros(size, dtype=np.int64)  # of the words of a shard
        self.length[shard] = lens
        depth = int(lens.max(initial=0))
        chars = _matrix(words, depth)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        node, ids = shard.astype(np.int64), np.arange(n)  # each word's node one level up
        for d in range(depth):
            keep = lens[ids] > d
            ids, node = ids[keep], node[keep]
            c = chars[ids, d]
            new = np.r_[True, (node[1:] != node[:-1]) | (c[1:] != c[:-1])]
            mine = np.cumsum(new) - 1
            parent, letter = node[new], c[new]
            word = np.full(len(letter), -1, dtype=np.int64)
            ends = lens[ids] == d + 1
            word[mine[ends]] = ids[ends]
            lo, hi = np.searchsorted(parent, np.arange(size)), np.searchsorted(parent, np.arange(size), side="right")
            self.levels.append((letter, lo, hi, word))
            size, node = len(letter), mine

    def near(self, queries: list[str], shard: np.ndarray, reach: Callable[[int], int], batch: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query index, word index, distance) with distance <= reach(len(query)), each query in its shard, batch by batch."""
        for at in range(0, len(queries), batch):
            yield from self._near(queries[at : at + batch], shard[at : at + batch], reach, at)

    def _near(self, queries, shard, reach, offset):
        lens = np.array([len(q) for q in queries], dtype=np.int64)
        limit = np.array([reach(len(q)) for q in queries], dtype=np.int16)
        k = int(limit.max(initial=0))
        width = 2 * k + 1
        letters = np.zeros((len(queries), int(lens.max(initial=0)) + 2), dtype=np.uint32)
        letters[:, 1:-1] = _matrix(queries, int(lens.max(initial=0)))  # letter j of a query is at column j
        q = np.arange(len(queries))
        node, target = shard.astype(np.int64), self.length[shard]
        j = np.arange(width) - k
        row = np.where((j >= 0) & (j <= lens[:, None]), j, FAR).astype(np.int16)
        before, last = np.full_like(row, FAR), np.zeros(len(queries), dtype=np.uint32)
        for d, (letter, lo, hi, word) in enumerate(self.levels):
            n = hi[node] - lo[node]
            at = np.repeat(np.arange(len(q)), n)
            if not len(at):
                return
            child = lo[node][at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            c, qa, ra, ba, la = letter[child], q[at], row[at], before[at], last[at]
            cur = np.full((len(at), width + 1), FAR, dtype=np.int16)  # the last column is a sentinel
            for b in range(width):
                j = d + 1 - k + b
                if j < 0:
                    continue
                if j == 0:
                    cur[:, b] = d + 1
                    continue
                inside = j <= lens[qa]
                cj = letters[qa, np.minimum(j, letters.shape[1] - 1)]
                v = ra[:, b] + (cj != c)
                if b + 1 < width:
                    v = np.minimum(v, ra[:, b + 1] + 1)
                if b:
                    v = np.minimum(v, cur[:, b - 1] + 1)
                if d and j > 1:
                    swap = (cj == la) & (letters[qa, np.minimum(j - 1, letters.shape[1] - 1)] == c)
                    v = np.where(swap, np.minimum(v, ba[:, b] + 1), v)
                cur[:, b] = np.where(inside, np.minimum(v, FAR), FAR)
            cur = cur[:, :width]
            end = lens[qa] - (d + 1) + k
            ok = (word[child] >= 0) & (end >= 0) & (end < width)
            hit = np.flatnonzero(ok)
            dist = cur[hit, end[hit]]
            good = dist <= limit[qa[hit]]
            if good.any():
                yield qa[hit][good] + offset, word[child][hit][good], dist[good]
            # edits so far, and those that the letters left on both sides need at least
            short = np.abs((target - lens)[qa, None] + (np.arange(width) - k)).astype(np.int16)
            alive = ((cur + short).min(1) <= limit[qa]) | ((ra + short).min(1) < limit[qa])
            q, node, row, before, last = qa[alive], child[alive], cur[alive], ra[alive], c[alive]
