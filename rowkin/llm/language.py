"""Language of posts and of passages in them: averaged hashed subword embeddings with a linear softmax.

A word is the mean of the embeddings of its hashed character n-grams, a span the mean of its words; a linear softmax
over languages sits on top.  Both are trained by stochastic gradient descent in numpy on spans of the labelled samples
(a bounded number of rows, ``MAX_SAMPLES``); held-out spans calibrate a temperature.  Since the model is linear, every word
has one score per language; a post is cut into passages by the best path over its words with a cost for changing the
language.

A passage's confidence is the calibrated softmax of its mean times the probability that its language is one of the known
ones: a logistic function of the shares of the passage's n-grams and words that the samples of its language hold, fitted on
spans held against few other samples of their language (known) and against other languages (unknown).  The
post's own label, which is what is judged, has no part in it.  Passages of low confidence are rejected.

Posts are worked on many at a time: words, scores and paths of a batch are numpy arrays, and the paths of all its posts
advance one word a step.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

from ..workspace import spread
from .words import DIGIT, LETTER, UPPER, Numbers, codes, joined, kinds, portions, runs, unmarked

BUCKETS = 1 << 15
DIM = 24
MAX_SAMPLES = 5000
MIN_WORDS = 12
SWITCH = 6.0  # cost of a change of language, in nats
REJECT = 0.25  # passages below this confidence have no language
FEW = 0.15  # share of the samples that known spans are held against
RIDGE, DEVIATE = 1e-6, 0.03  # how firmly the slopes, and the offsets of languages against their mean, are held to 0
DROP = 0.7  # share of a word's n-grams, the whole word among them, that a step of the training leaves out
KEPT = 200_000  # words whose scores a task remembers

LINK = re.compile(r"(?:https?://|www\.)\S+|(?<!\S)[^\s@]++@\S+\.\S+")


def features(word: str) -> np.ndarray:
    """Hashed n-grams of 1 to 4 letters and the whole word; word boundaries count as letters."""
    w = f"<{word}>"
    grams = {w} | {w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1)}
    return np.fromiter((xxhash.xxh32_intdigest(g) % BUCKETS for g in sorted(grams)), dtype=np.int64)


def telling(word: str) -> np.ndarray:
    """Hashed n-grams of 3 and 4 letters, which tell known from unknown languages."""
    w = f"<{word}>"
    grams = {w[i : i + n] for n in (3, 4) for i in range(len(w) - n + 1)}
    return np.fromiter((xxhash.xxh32_intdigest(g) % BUCKETS for g in sorted(grams)), dtype=np.int64)


def _bucket(word: str) -> int:
    return xxhash.xxh32_intdigest(word, seed=1) % BUCKETS


def clean(text: str) -> str:
    text = unmarked(text)
    return LINK.sub(" 0 ", text) if "@" in text or "://" in text or "www." in text else text


def cut(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words of cleaned texts, the text of each, and its begin and end there; numbers and the names right before them are
    left out, and an apostrophe between letters is part of the word."""
    text, begins = joined(texts)
    points = codes(text)
    kind = kinds(points)
    letter = (kind & LETTER).astype(bool)
    inner = ((points[1:-1] == 0x27) | (points[1:-1] == 0x2019)) & letter[:-2] & letter[2:]
    letter[1:-1] |= inner
    a, b = runs(letter * np.uint8(1) + (kind & DIGIT))
    number = (kind[a] & DIGIT).astype(bool)
    named = np.zeros(len(a), dtype=bool)  # "Name 123"
    named[:-1] = ((kind[a[:-1]] & UPPER) > 0) & number[1:] & (a[1:] - b[:-1] == 1)
    keep = ~number & ~named
    a, b = a[keep], b[keep]
    of = np.searchsorted(begins, a, side="right") - 1
    return [text[x:y] for x, y in zip(a.tolist(), b.tolist())], of, a - begins[of], b - begins[of]


def words_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-case words of a cleaned text with their places."""
    words, _, a, b = cut([text])
    return [folded(w) for w in words], list(zip(a.tolist(), b.tolist()))


def folded(word: str) -> str:
    return word.lower().replace("’", "'")


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(-1, keepdims=True))
    return z / z.sum(-1, keepdims=True)


def best_paths(e: np.ndarray, begin: np.ndarray, size: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Language of every word on the best path of its text; ``e``: log scores, a row a word; texts begin at ``begin``.

    All texts advance one word a step.  For each language the word is kept at which its current run began, and for each word
    the leading language before it with the begin of that one's run, so a path is read back run by run.
    """
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    leader, began = np.zeros(len(e), dtype=np.int16), np.zeros(len(e), dtype=np.int32)
    best, since, longest = e[begin], np.zeros((len(begin), e.shape[1]), dtype=np.int32), int(size.max(initial=0))
    live = np.searchsorted(-size, -np.arange(longest + 1), side="left")  # texts of more than t words
    each = np.arange(len(begin))
    for t in range(1, longest):
        m = live[t]
        now, rows = best[:m], begin[:m] + t
        at = now.argmax(1)
        least = now[each[:m], at] - switch
        leader[rows], began[rows] = at, since[each[:m], at]
        since[:m][now < least[:, None]] = t
        best[:m] = np.maximum(now, least[:, None]) + e[rows]
    path, last = np.zeros(len(e), dtype=np.int16), best.argmax(1)
    for a, n, lang, start in zip(begin.tolist(), size.tolist(), last.tolist(), since[each, last].tolist()):
        path[a + start : a + n] = lang
        while start:
            n, lang, start = start, leader[a + start], began[a + start]
            path[a + start : a + n] = lang
    return path


class Model:
    """``table``: the product of embeddings and softmax weights, a row of language scores per n-gram bucket; ``grams`` and
    ``whole``: which n-grams and words the samples of each language hold; ``offset`` and ``known``: weights of the logit that a language is known."""

    def __init__(self, langs: list[str], table: np.ndarray, bias: np.ndarray, scale: tuple[float, float], grams: np.ndarray, whole: np.ndarray, offset: np.ndarray, known: tuple[float, float]):
        self.langs, self.table, self.bias, self.scale, self.grams, self.whole, self.offset, self.known = langs, table, bias, scale, grams, whole, offset, known
        self._forget()

    def __reduce__(self):
        return Model, (self.langs, self.table, self.bias, self.scale, self.grams, self.whole, self.offset, self.known)

    def _forget(self) -> None:
        self._numbers, self._rows = Numbers(self._learn), np.empty((1024, 2 * len(self.langs)), dtype=np.float32)

    def _learn(self, word: str) -> None:
        n = len(self._numbers) - 1
        if n == len(self._rows):
            self._rows = np.concatenate([self._rows, np.empty_like(self._rows)])
        w = folded(word)
        self._rows[n] = np.r_[self.table[features(w)].mean(0), self.known[0] * self.grams[telling(w)].mean(0) + self.known[1] * self.whole[_bucket(w)]]

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per word and language the score, and what it adds to the logit that the language is known."""
        if len(self._numbers) > KEPT:
            self._forget()
        at = self._numbers.of(words)  # may lengthen the rows
        both = self._rows[at]
        return both[:, : len(self.langs)], both[:, len(self.langs) :]

    def judged(self, mean: np.ndarray, known: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and confidence of spans of ``n`` words with mean scores and mean shares of the logit."""
        p = _softmax((mean + self.bias) * (self.scale[0] * n ** self.scale[1])[:, None])
        lang = p.argmax(1)
        at = np.arange(len(lang))
        return lang, p[at, lang] / (1 + np.exp(-self.offset[lang] - known[at, lang]))

    def many(self, words: list[str], of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words, language and confidence of every passage of texts whose words follow each other;
        ``of``: the text of each word."""
        if not words:
            return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
        s, known = self.scores(words)
        e = (s + self.bias) * self.scale[0]
        e -= np.log(np.exp(e - e.max(1, keepdims=True)).sum(1, keepdims=True)) + e.max(1, keepdims=True)
        e = np.maximum(e, -7.0)  # one odd word can't force a change
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        path = best_paths(e, begin, np.diff(np.r_[begin, len(of)]))
        first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (path[1:] != path[:-1])])
        while True:  # neighbours that the mean gives one language become one
            n = np.diff(np.r_[first, len(of)])
            mean = np.add.reduceat(s.astype(np.float64), first) / n[:, None]
            lang, sure = self.judged(mean, np.add.reduceat(known.astype(np.float64), first) / n[:, None], n.astype(float))
            new = np.r_[True, (of[first[1:]] != of[first[:-1]]) | (lang[1:] != lang[:-1])]
            if new.all():
                break
            first = first[new]
        return first, n, lang, sure

    def passages(self, words: list[str]) -> list[tuple[int, int, str, float]]:
        """(first word, last word + 1, language, confidence) of each passage of one text; the words are all covered."""
        first, n, lang, sure = self.many(words, np.zeros(len(words), dtype=np.int64))
        return [(a, a + m, self.langs[k], p) for a, m, k, p in zip(first.tolist(), n.tolist(), lang.tolist(), sure.tolist())]


def train(texts: list[str], labels: list[str], seed: int = 7, epochs: int = 30) -> Model:
    """Softmax regression on averaged embeddings, both learned by SGD with random spans of 1 to 14 words."""
    langs = sorted(set(labels))
    at = {x: i for i, x in enumerate(langs)}
    rng = np.random.default_rng(seed)
    docs = [(words_of(clean(t))[0], at[y]) for t, y in zip(texts, labels)]
    docs = [(w, y) for w, y in docs if w]
    order = rng.permutation(len(docs))
    held = set(order[: max(len(docs) // 10, 1)].tolist()) if len(docs) >= 20 else set()
    feats = {w: features(w) for ws, _ in docs for w in ws}
    emb = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(langs)), dtype=np.float32)
    bias = np.zeros(len(langs), dtype=np.float32)

    def mean_of(ws: list[str]) -> tuple[np.ndarray, list]:
        fs = [f[k] if (k := rng.random(len(f)) >= DROP).any() else f for f in (feats[w] for w in ws)]
        return np.mean([emb[f].mean(0) for f in fs], axis=0), fs

    steps, total = 0, epochs * len(docs)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            steps += 1
            if i in held:
                continue
            ws, y = docs[i]
            rate = 0.5 * (1 - steps / total) + 0.02
            n = int(rng.integers(1, 15))
            a = int(rng.integers(0, max(len(ws) - n, 0) + 1))
            x, fs = mean_of(ws[a : a + n])
            z = x @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            g = out @ p
            out -= rate * np.outer(x, p)
            bias -= rate * 0.1 * p
            for f in fs:
                np.subtract.at(emb, f, (rate * 4 / (len(fs) * len(f)) * g).astype(np.float32))
    table = emb @ out
    score = {w: table[f].mean(0) for w, f in feats.items()}
    spans = []
    for i in held or range(len(docs)):
        ws, y = docs[i]
        for n in (1, 2, 4, 8, 12):
            for a in range(0, max(len(ws) - n, 0) + 1, n):
                if len(ws[a : a + n]) == n:
                    spans.append((n, np.mean([score[w] for w in ws[a : a + n]], axis=0) + bias, y))
    best = (float("inf"), (1.0, 0.0))
    for c in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8):
        for power in (0.0, 0.25, 0.5, 0.75, 1.0):
            loss = 0.0
            for n, z, y in spans:
                z = z * (c * n**power)
                loss += np.log(np.exp(z - z.max()).sum()) + z.max() - z[y]
            best = min(best, (loss / max(len(spans), 1), (c, power)))
    return Model(langs, table.astype(np.float32), bias, best[1], *familiar(docs, score, bias, len(langs)))


def familiar(docs: list[tuple[list[str], int]], score: dict[str, np.ndarray], bias: np.ndarray, k: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[float, float]]:
    """Which buckets of telling n-grams and of whole words each language's samples hold, and the weights (an offset for
    each language, n-grams, words) of the logit that a span's language is known.

    Known are spans of a sample held against FEW of the other samples of its language, as a text's words are mostly not those
    of the samples; unknown are the same spans held against the language that the model would choose had it not learned theirs.
    """
    rng = np.random.default_rng(seed)
    grams, whole = {w: telling(w) for ws, _ in docs for w in ws}, {w: _bucket(w) for ws, _ in docs for w in ws}
    own = [(np.unique(np.concatenate([grams[w] for w in ws])), np.unique([whole[w] for w in ws])) for ws, _ in docs]
    seen = np.zeros((2, BUCKETS, k), dtype=np.float32)
    of = [np.array([i for i, (_, y) in enumerate(docs) if y == lang]) for lang in range(k)]
    for (g, w), (_, y) in zip(own, docs):
        seen[0, g, y] = seen[1, w, y] = 1
    x, target, judged = [], [], []
    for i, (ws, y) in enumerate(docs):
        others = of[y][of[y] != i]
        part = np.zeros((2, BUCKETS), dtype=np.float32)
        for j in rng.permutation(others)[: max(1, round(FEW * len(others)))]:
            part[0, own[j][0]] = part[1, own[j][1]] = 1
        for n in (8, 12):
            for a in range(0, len(ws) - n + 1, n):
                span = ws[a : a + n]
                if len(others):
                    x.append([np.mean([part[0, grams[w]].mean() for w in span]), np.mean([part[1, whole[w]] for w in span])])
                    target.append(1.0)
                    judged.append(y)
                if k > 1:
                    z = np.mean([score[w] for w in span], axis=0) + bias
                    z[y] = -np.inf
                    b = z.argmax()
                    x.append([np.mean([seen[0, grams[w], b].mean() for w in span]), np.mean([seen[1, whole[w], b] for w in span])])
                    target.append(0.0)
                    judged.append(b)
    return seen[0], seen[1], *_logistic(np.array(x).reshape(-1, 2), np.array(target), np.eye(k)[judged] if judged else np.empty((0, k)))


def _logistic(x: np.ndarray, target: np.ndarray, of: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, tuple[float, float]]:
    """Offset of each kind ``of`` and slopes by Newton steps, both targets weighted alike; certain if there is only one."""
    k = of.shape[1]
    if not len(target) or target.min() == target.max():
        return np.full(k, 20.0), (0.0, 0.0)
    weight = np.where(target == 1, 0.5 / target.sum(), 0.5 / (1 - target).sum())
    a = np.c_[np.ones(len(x)), x, of]
    w = np.zeros(a.shape[1])
    hold = ridge * np.r_[1e-6, 1, 1, np.full(k, DEVIATE)]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(hold), a.T @ (weight * (p - target)) + hold * w)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
    return w[0] + w[3:], (float(w[1]), float(w[2]))


# Notations of the languages, without region: two- and three-letter codes, own and English names.
NOTATIONS = {
    "en": ("en", "eng", "english", "englisch", "anglais", "inglés"),
    "de": ("de", "deu", "ger", "german", "deutsch", "allemand", "alemán"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais", "französisch"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano", "spanisch"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "it": ("it", "ita", "italian", "italiano"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands"),
    "sv": ("sv", "swe", "swedish", "svenska"),
    "pl": ("pl", "pol", "polish", "polski"),
    "ru": ("ru", "rus", "russian", "русский"),
}


def label_of(c, langs: list[str] = ()):
    """Code of the language that a label names: one of ``langs`` itself, or any notation of those in NOTATIONS; else null."""
    from pyspark.sql import functions as F

    k = F.regexp_replace(F.lower(F.trim(c)), r"[-_ (].*$", "")
    out = F.lit(None).cast("string")
    for code, names in NOTATIONS.items():
        out = F.when(k.isin(*names), F.lit(code)).otherwise(out)
    for code in langs:
        out = F.when(k == code.lower(), F.lit(code)).otherwise(out)
    return out


def fitted(samples, lang: str = "lang", text: str = "sample_text", most: int = MAX_SAMPLES) -> Model:
    """The model of the labelled samples.  At most ``most`` rows are used, those of the smallest text hash: the model
    needs a bounded sample, whatever the size of the table."""
    from pyspark.sql import functions as F

    rows = samples.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(lang, text)
    got = rows.orderBy(F.xxhash64(text), text).limit(most).collect()
    return train([r[1] for r in got], [r[0] for r in got])


def passages(docs, model: Model):
    """(doc_id, passage, lang, confidence, n_words, first_char, last_char) of every passage with a language.

    Each document gives one row per stretch of words of one language, in order; names before numbers, numbers, links and markup
    are left out.  Null ids, null or empty texts and texts without words give no row; a passage whose confidence is under
    ``REJECT``, as those of languages without samples, has lang null.  Places are code points of the text without markup.
    Other columns, the label among them, are ignored.
    """
    import pandas as pd
    from pyspark.sql import functions as F

    names = np.array([*model.langs, None], dtype=object)

    def run(batches):
        for pdf in batches:
            ids, texts = pdf["doc_id"].to_numpy(), [clean(t) if isinstance(t, str) else "" for t in pdf["text"]]
            for x, y in portions(texts):
                words, of, a, b = cut(texts[x:y])
                first, n, lang, sure = model.many(words, of)
                doc = of[first] if len(first) else first
                new = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.empty(0, dtype=bool)
                at = np.arange(len(doc))
                yield pd.DataFrame({
                    "doc_id": ids[x:y][doc], "passage": at - np.maximum.accumulate(np.where(new, at, 0)), "lang": names[np.where(sure >= REJECT, lang, -1)],
                    "confidence": sure, "n_words": n, "first_char": a[first], "last_char": b[first + n - 1],
                })

    schema = "doc_id long, passage int, lang string, confidence double, n_words int, first_char int, last_char int"
    return spread(docs.where("doc_id is not null").select("doc_id", "text"), "doc_id").mapInPandas(run, schema)


def mislabelled(docs, model: Model, min_words: int = MIN_WORDS):
    """(doc_id, lang): languages with ``min_words`` words in a row, of posts whose label is missing, names another
    language, or which hold more than one such language."""
    from pyspark.sql import functions as F

    counts = (
        passages(docs, model)
        .where((F.col("n_words") >= min_words) & F.col("lang").isNotNull())
        .groupBy("doc_id")
        .agg(F.collect_set("lang").alias("langs"))
    )
    label = docs.select("doc_id", label_of(F.col("lang"), model.langs).alias("label"))
    wrong = (F.size("langs") > 1) | F.col("label").isNull() | ~F.array_contains("langs", F.col("label"))
    return counts.join(label, "doc_id").where(wrong).select("doc_id", F.explode("langs").alias("lang"))
