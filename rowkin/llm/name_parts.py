"""Person names as people type them: words, roles, initials, short forms and typos."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

# Cells without a name (letters and digits), titles, degrees and suffixes, all lower case.
BLANKS = {"", "unknown", "unk", "unkn", "na", "none", "null", "nil", "nan", "nmn", "noname", "nomiddlename", "nomiddle", "notgiven", "notprovided", "nonegiven", "missing", "redacted", "x", "xx", "xxx"}
TITLES = {"dr", "mr", "mrs", "ms", "miss", "prof", "rev", "sir"}
DEGREES = {"phd", "md", "dds", "esq", "mba", "rn", "cpa", "jd"}
SUFFIX = {"jr": "jr", "junior": "jr", "jnr": "jr", "sr": "sr", "senior": "sr", "snr": "sr", "ii": "2", "2nd": "2", "iii": "3", "3rd": "3", "iv": "4", "4th": "4"}
LOOKALIKE = str.maketrans({"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "6": "b", "7": "t", "8": "b"})
PLAIN = str.maketrans({"ł": "l", "ø": "o", "ß": "ss", "æ": "ae", "đ": "d", "þ": "th", "œ": "oe"})


class Name(NamedTuple):
    first: tuple[str, ...]
    middle: tuple[str, ...]
    last: tuple[str, ...]
    suffix: str


_CONTROLS = {c: " " for c in [*range(32), 127]}


def folded(cell: str | None) -> str:
    if not isinstance(cell, str):
        return ""
    if cell.isascii():
        return cell.lower().translate(_CONTROLS).strip()
    text = unicodedata.normalize("NFKD", cell.lower())
    text = "".join(" " if unicodedata.category(c) in ("Cf", "Zs", "Cc") else c for c in text if not unicodedata.combining(c))
    return text.translate(PLAIN).strip()


def _words(text: str, found: list[str]) -> tuple[str, ...]:
    if re.sub(r"[^a-z0-9]", "", text) in BLANKS:
        return ()
    out = []
    for w in re.findall(r"[a-z0-9]+", text.replace("'", "").replace("’", "").replace(".", " ")):
        if w in SUFFIX:
            found.append(SUFFIX[w])
        elif w in TITLES or w in DEGREES or w.isdigit():
            pass
        else:
            out.append(w.translate(LOOKALIKE))
    # degrees and suffixes written with points: Ph.D.
    joined = " ".join(out)
    joined = re.sub(r"\bph d\b|\bm d\b", "", joined)
    return tuple(joined.split())


def parsed(first: str | None, middle: str | None, last: str | None, suffix: str | None) -> Name:
    """Names by role; 'Last, First Middle' in one cell is taken apart, titles and degrees are dropped."""
    found: list[str] = []
    f, m, l, s = folded(first), folded(middle), folded(last), folded(suffix)  # noqa: E741
    if s := re.sub(r"[^a-z0-9]", "", s):
        found += [SUFFIX[s]] if s in SUFFIX else []
    lw, mw = _words(l, found), _words(m, found)
    if "," in f and not lw:
        a, b = f.split(",", 1)
        lw, fw = _words(a, found), _words(b, found)
    elif "," in l and not _words(f, []):
        a, b = l.split(",", 1)
        lw, fw = _words(a, found), _words(b, found)
    else:
        fw = _words(f, found)
    if not lw and len(fw) > 1:
        fw, lw = fw[:-1], fw[-1:]
    if len(fw) > 1 and not mw:
        fw, mw = fw[:1], fw[1:]
    return Name(fw, mw, lw, found[0] if found else "")


def tokens(n: Name) -> list[str]:
    """Words of at least two letters, and each part's words run together."""
    out = {w for part in (n.first, n.middle, n.last) for w in part if len(w) > 1}
    out |= {"".join(part) for part in (n.first + n.middle, n.first, n.last) if 1 < len(part) < 5}
    return sorted(out)


def reach(n: int) -> int:
    """How many edits two words may differ by, if the shorter has n letters."""
    return 0 if n < 3 else 1 if n < 8 else 2


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with neighbour swaps, most + 1 if larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        if min(new) > most and min(row) > most:
            return most + 1
        before, row = row, new
    return row[-1]


class Matcher:
    """Whether words and names may be the same; ``forms`` are (given name, short form) pairs."""

    def __init__(self, forms: list[tuple[str, str]]):
        self.forms: dict[str, set[str]] = {}
        for given, short in forms:
            g, s = folded(given), folded(short)
            if g and s:
                self.forms.setdefault(s, set()).add(g)
                self.forms.setdefault(g, set()).add(g)

    def word(self, a: str, b: str) -> int:
        """3 equal or a known short form, 2 typo or cut short, 1 initial, 0 different."""
        if a == b:
            return 3
        if len(a) == 1 or len(b) == 1:
            return 1 if a[0] == b[0] else 0
        fa, fb = self.forms.get(a), self.forms.get(b)
        if fa and fb and fa & fb:
            return 3
        n = min(len(a), len(b))
        if n >= 3 and (a.startswith(b) or b.startswith(a)):
            return 2
        k = reach(n)
        return 2 if k and edits(a, b, k) <= k else 0

    def part(self, a: tuple[str, ...], b: tuple[str, ...]) -> int:
        """Best agreement of two parts: any word with any word, or both run together."""
        if not a or not b:
            return -1
        best = max(self.word(x, y) for x in a for y in b)
        if best < 2 and (len(a) > 1 or len(b) > 1):
            best = max(best, 2 if self.word("".join(a), "".join(b)) >= 2 else 0)
        return best

    def names(self, a: Name, b: Name) -> tuple[int, int]:
        """Agreement of given names and of family names (-1: not known), in the better of both orders."""
        ways = [(self.part(a.first, b.first), self.part(a.last, b.last))]
        # which of the two is turned round isn't known: what agrees counts as the family name, which relatives share
        ways.append(tuple(sorted((self.part(a.first, b.last), self.part(a.last, b.first)))))
        if ways[0][0] == 0 and self.part(a.middle, b.first) >= 2 and len(a.first) == 1 == len(a.first[0]):
            ways.append((self.part(a.middle, b.first), ways[0][1]))
        if ways[0][0] == 0 and self.part(a.first, b.middle) >= 2 and len(b.first) == 1 == len(b.first[0]):
            ways.append((self.part(a.first, b.middle), ways[0][1]))
        x, y = a.first + a.middle + a.last, b.first + b.middle + b.last
        if 3 <= len(x) == len(y) <= 6 and min(ways[0]) < 2 and (least := self.permuted(x, y)):
            ways.append((least, least))
        return max(ways, key=lambda w: (min(w), sum(w)))

    def permuted(self, a: tuple[str, ...], b: tuple[str, ...]) -> int:
        """The least agreement under the best order of the words of ``b`` in which each agrees with its word of ``a``, else 0."""
        if not a:
            return 3
        rest = ((v, b[:i] + b[i + 1 :]) for i, y in enumerate(b) if (v := self.word(a[0], y)) >= 2)
        return max((min(v, self.permuted(a[1:], left)) for v, left in rest), default=0)
