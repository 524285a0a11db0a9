"""One-versus-rest linear classifiers on hashed word n-grams, for the subject areas of paragraphs.

Words are runs of letters, and single ideographs; features are the words and the pairs of neighbouring words, hashed
to a fixed number of slots. Labels are of whole documents, so a document with several areas is trained by turns:
each paragraph goes to the one of its document's areas that the model of the last turn finds likeliest.
"""

from __future__ import annotations

import re

import numpy as np

SLOTS = 2**17
_SPLIT = re.compile(r"[\r\n]+")
_P = np.uint64(0x9E3779B97F4A7C15)


def paragraphs(text: str | None) -> list[str]:
    return [p for p in map(str.strip, _SPLIT.split(text or "")) if p]


_CLASS: np.ndarray | None = None


def _classes() -> np.ndarray:
    """Code point to 0 (no word), 1 (letter of a run), 2 (a word of its own)."""
    global _CLASS
    if _CLASS is None:
        c = np.zeros(0x110000, np.uint8)
        for cp in range(0x2E80):
            c[cp] = chr(cp).isalpha()
        c[0x2E80:0xA000] = 2
        c[0x3000:0x3040] = 0
        c[0xAC00:0xD7B0] = 2
        c[0xF900:0xFB00] = 2
        c[0x20000:0x32000] = 2
        c[0xFF21:0xFF3B] = c[0xFF41:0xFF5B] = 1
        _CLASS = c
    return _CLASS


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text number) of each word and each pair of neighbouring words; pairs don't span other characters but blanks between letters."""
    joined = "\n".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(cp):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _classes()[cp]
    ends = np.cumsum([len(t) + 1 for t in texts])
    start = (kind == 2) | ((kind == 1) & np.concatenate([[True], kind[:-1] != 1]))
    first = np.flatnonzero(start)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = np.cumsum(start) - 1
    live = kind > 0
    at = np.flatnonzero(live)
    with np.errstate(over="ignore"):
        low = np.where((cp >= 65) & (cp <= 90), cp + 32, cp).astype(np.uint64)
        place = (at - first[word[at]]).astype(np.uint64)
        part = (low[at] + np.uint64(1)) * (_P * (place + np.uint64(3)) | np.uint64(1))
        part ^= part >> np.uint64(31)
        h = np.add.reduceat(part * np.uint64(0xBF58476D1CE4E5B9), np.searchsorted(at, first))
        last = np.append(at[np.searchsorted(at, first[1:]) - 1], at[-1])
        gap = first[1:] - last[:-1]
        near = (gap == 1) | ((gap == 2) & (cp[last[:-1] + 1] == 32))
        two = (h[:-1] * np.uint64(31) + h[1:]) * np.uint64(0x94D049BB133111EB)
        slots = np.concatenate([h >> np.uint64(40), two[near] >> np.uint64(40)]) % np.uint64(SLOTS)
    text = np.searchsorted(ends, first, side="right")
    return slots.astype(np.int64), np.concatenate([text, text[:-1][near]])


class Linear:
    """Weights (SLOTS, areas), bias and thresholds; a text's score is the mean weight of its features by the root of their number."""

    def __init__(self, areas: list[str]):
        self.areas = areas
        self.w = np.zeros((SLOTS, len(areas)), np.float32)
        self.b = np.zeros(len(areas), np.float32)
        self.threshold = np.zeros(len(areas), np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        slots, owner = features(texts)
        return self._sum(slots, owner, len(texts))

    def _sum(self, slots: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        size = np.bincount(owner, minlength=n)
        order = np.argsort(owner, kind="stable")
        out = np.zeros((n, len(self.areas)), np.float32)
        o = owner[order]
        for lo in range(0, len(o), 2_000_000):
            hi = min(len(o), lo + 2_000_000)
            cuts = np.flatnonzero(np.concatenate([[True], o[lo + 1 : hi] != o[lo : hi - 1]]))
            np.add.at(out, o[lo:hi][cuts], np.add.reduceat(self.w[slots[order[lo:hi]]], cuts, axis=0))
        return out / np.sqrt(np.maximum(size, 1))[:, None] + self.b

    def fit(self, texts: list[str], y: np.ndarray, passes: int, rate: float = 1.0, least: int = 2) -> None:
        """Logistic loss of each area against the rest over all texts, by adaptive steps from the present weights. y: (texts, areas) of 0, 1, or NaN for unknown.

        Features of fewer than ``least`` texts get no weight.
        """
        slots, owner = features(texts)
        seen = np.bincount(np.unique(np.stack([slots, owner], 1), axis=0)[:, 0], minlength=SLOTS) if len(slots) else np.zeros(SLOTS, np.int64)
        keep = seen[slots] >= least
        slots, owner = slots[keep], owner[keep]
        size = np.sqrt(np.maximum(np.bincount(owner, minlength=len(texts)), 1)).astype(np.float32)
        by_text, by_slot = np.argsort(owner, kind="stable"), np.argsort(slots, kind="stable")
        used, cuts = np.unique(slots[by_slot], return_index=True)
        text_ids, text_cuts = np.unique(owner[by_text], return_index=True)
        if not len(used):
            return
        compact = np.searchsorted(used, slots)[by_text]
        back = owner[by_slot]
        w, b, unknown, true = self.w[used], self.b.copy(), np.isnan(y), np.nan_to_num(y).astype(np.float32)
        gw2, gb2 = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
        n = len(texts)
        for _ in range(passes):
            z = np.zeros((n, len(self.areas)), np.float32)
            z[text_ids] = np.add.reduceat(w[compact], text_cuts, axis=0)
            z = z / size[:, None] + b
            err = (1 / (1 + np.exp(-z)) - true) / n
            err[unknown] = 0
            g = np.add.reduceat((err / size[:, None])[back], cuts, axis=0)
            gb = err.sum(0)
            gw2 = 0.9 * gw2 + g**2
            gb2 = 0.9 * gb2 + gb**2
            w -= rate * g / np.sqrt(gw2)
            b -= rate * 0.3 * gb / np.sqrt(gb2)
        self.w[used], self.b = w, b


def fit_areas(docs: list[tuple[str, set[str]]], areas: list[str], passes: tuple[int, ...] = (20, 8, 8), weak: list[tuple[str, dict[str, float]]] = ()) -> Linear:
    """docs: (text, all its areas); weak: (text, areas that it has with the probabilities given).

    Paragraphs of documents with several areas are labelled by turns, in the first of which they teach only what they
    aren't about. Of the documents with a weak label, as many as its probability promises, those with the likeliest
    paragraphs, are trained on with that paragraph; the others, and their other paragraphs, are left open.
    """
    texts, owner = [], []
    full = len(docs)
    docs = [*docs, *weak]
    for i, (text, _) in enumerate(docs):
        for p in paragraphs(text):
            texts.append(p)
            owner.append(i)
    owner_a = np.array(owner, np.int64)
    index = {a: k for k, a in enumerate(areas)}
    allowed = np.zeros((len(docs), len(areas)), bool)
    for i, (_, have) in enumerate(docs):
        for a in have:
            if a in index:
                allowed[i, index[a]] = True
    mask = allowed[owner_a] if len(owner) else np.zeros((0, len(areas)), bool)
    single = (mask.sum(1) == 1) & (owner_a < full)
    model = Linear(areas)
    y = np.where(mask, np.nan, 0.0)
    y[single] = mask[single]
    for r, n in enumerate(passes):
        keep = np.flatnonzero(owner_a < full) if r == 0 else np.arange(len(texts))
        if not len(keep):
            return model
        model.fit([texts[i] for i in keep], y[keep], n)
        s = np.where(mask, model.scores(texts), -np.inf)
        y = np.zeros((len(texts), len(areas)))
        best = s.argmax(1)
        y[np.arange(len(texts)), best] = mask.any(1)
        for i in np.flatnonzero(allowed.sum(1) > 1):  # each area of a document has a paragraph
            rows = np.flatnonzero(owner_a == i)
            for a in np.flatnonzero(allowed[i]):
                if len(rows) and not y[rows, a].any():
                    top = rows[s[rows, a].argmax()]
                    if y[rows, best[top]].sum() > 1:
                        y[top] = 0
                        y[top, a] = 1
        y[owner_a >= full] = np.nan
        promised: dict[tuple[int, float], list[tuple[float, int]]] = {}
        for i in range(full, len(docs)):
            rows = np.flatnonzero(owner_a == i)
            for name, p in docs[i][1].items():
                if name in index and len(rows):
                    top = rows[s[rows, index[name]].argmax()]
                    promised.setdefault((index[name], p), []).append((float(s[top, index[name]]), int(top)))
        for (k, p), found in promised.items():
            for _, top in sorted(found, reverse=True)[: round(p * len(found))]:
                y[top] = 0
                y[top, k] = 1
    return model


def document_areas(model: Linear, texts: list[str | None]) -> list[list[str]]:
    """The areas of each document: those of its paragraphs. A paragraph's area is its best one, if the score reaches the area's
    threshold; the document's surest paragraph counts at any score, and so does a doubtful one whose area a sure one has."""
    split = [paragraphs(t) for t in texts]
    scores = model.scores([p for ps in split for p in ps])
    out, at = [], 0
    for ps in split:
        s = scores[at : at + len(ps)]
        at += len(ps)
        if not len(ps):
            out.append([])
            continue
        best, top = s.argmax(1), s.max(1)
        sure = top >= model.threshold[best]
        sure[top.argmax()] = True
        out.append(sorted({model.areas[k] for k in best[sure]}))
    return out


def calibrate(model: Linear, docs: list[tuple[str, set[str]]], least: int = 5) -> None:
    """For each area the threshold with the fewest errors over held-out documents, by their best paragraph of the area; the middle of the best
    range, and that of all areas together for areas with fewer than ``least`` such documents."""
    rows: list[tuple[int, float, bool]] = []
    for text, have in docs:
        ps = paragraphs(text)
        if not ps:
            continue
        s = model.scores(ps)
        best, top = s.argmax(1), s.max(1)
        for k in set(best.tolist()):
            if k != best[top.argmax()]:
                rows.append((k, float(top[best == k].max()), model.areas[k] in have))

    def cut(r: list[tuple[int, float, bool]]) -> float:
        score, true = np.array([x[1] for x in r]), np.array([x[2] for x in r])
        order = np.argsort(score)
        score, true = score[order], true[order]
        errors = np.concatenate([[0], np.cumsum(true)]) + np.concatenate([np.cumsum((~true)[::-1])[::-1], [0]])  # i lowest left out
        at = np.flatnonzero(errors == errors.min())
        i = int(at[len(at) // 2])
        lo, hi = score[i - 1] if i else score[0] - 2.0, score[i] if i < len(score) else score[-1] + 2.0
        return float((lo + hi) / 2)

    common = cut(rows) if rows else 0.0
    for k in range(len(model.areas)):
        own = [r for r in rows if r[0] == k]
        model.threshold[k] = (cut(own) + common) / 2 if sum(r[2] for r in own) >= least and not all(r[2] for r in own) else common
