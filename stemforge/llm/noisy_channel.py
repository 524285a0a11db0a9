"""Noisy-channel repair of misrecognised characters.

A recognised string is the true one sent through a channel of character confusions; the repair is the most likely
true string under the channel times a language model, by Viterbi: over the candidates of doubtful places in ideographs,
where neighbouring places share trigrams, and over the candidate words of a line, where neighbouring words share
bigrams. The language model is made of counts of all texts. The counts hold the noise itself, so each count is freed of
what the channel explains: of a trigram with a doubtful character, the channel's share of the same trigram with the
true one is taken off before the comparison.

All counts sit in one hashed table of fixed size (two rows, the lesser value counts), which has only what can be asked
for: trigrams with a character that is seen or true in a confusion, words, and pairs of neighbouring words.
"""

from __future__ import annotations

import difflib
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

#: Slots of a row of the count table: 2 rows of 16 MB whatever the corpus.
SLOTS = 2**22
#: Signs that stand for a character which couldn't be read.
UNREADABLE = re.compile("[�■□-]")
WORD = re.compile(r"[A-Za-z0-9À-ſ]+")
HYPHENED = re.compile(r"[A-Za-zÀ-ſ]+(?:-[A-Za-zÀ-ſ]+)+")
HAN = re.compile("[㐀-鿿]")

# Confusions known of scanned print, seen to true.
CONFUSIONS = {
    "白勺": "的", "歹刂": "列", "日月": "明", "女子": "好", "木目": "相", "著": "者", "苦": "若", "迷": "述", "烏": "為", "吋": "時", "寮": "察", "蒂": "帶", "宄": "先",
    "碓": "確", "堍": "境", "氏": "民", "綠": "錄", "科": "料", "絞": "較", "攺": "改", "村": "材", "裎": "程", "嚮": "響", "諭": "論", "攄": "據", "頂": "項",
    "囚": "因", "己": "已", "末": "未", "士": "土", "人": "入", "曰": "日", "千": "干", "大": "太", "天": "夭", "候": "侯", "析": "折",
    "rn": "m", "cl": "d", "vv": "w", "li": "h", "h": "ti", "c": "e", "1": "l", "0": "o", "5": "s", "l": "1", "O": "0", "o": "0", "S": "5", "B": "8", "I": "1", "8": "B",
}
PRIOR_RATE = 1e-3
#: The channel's rate is taken this many times when counts are freed of noise.
SAFETY = 3.0
#: Share of a word's occurrences that noise may have spoilt in one way, at least.
WORD_NOISE = 0.01
#: Log odds that a repair must reach.
MARGIN = 1.5
#: Weight of what pairs of neighbouring words say beside the words' own odds.
CONTEXT = 1.0
#: Runs of more letters and digits than this aren't words (addresses, codes) and stay as they are.
LONGEST_WORD = 60
DIGITS_SEEN = str.maketrans({"l": "1", "I": "1", "O": "0", "o": "0", "S": "5", "B": "8"})


def _slots(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        a = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(32)
        b = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        b ^= b >> np.uint64(29)
    return (a % np.uint64(SLOTS)).astype(np.int64), (b % np.uint64(SLOTS)).astype(np.int64)


def _trigrams(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return (cp[:-2] << np.uint64(42)) | (cp[1:-1] << np.uint64(21)) | cp[2:]


def _word_key(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 1 << 63


def folded(text: str) -> str:
    """Digits as one sign, as their values say nothing about a context, with edges."""
    return "\n\n" + re.sub("[0-9]", "0", text) + "\n\n"


def _pairs(text: str) -> Iterator[tuple[str, str]]:
    """Neighbouring words, one blank apart."""
    last = None
    for m in WORD.finditer(text):
        if last is not None and m.start() == last.end() + 1 and text[last.end()] == " ":
            yield last[0], m[0]
        last = m


def count_texts(texts: Iterable[str], asked: str | None = None) -> np.ndarray:
    """(2, SLOTS) counts of the texts' trigrams, words, hyphened words and pairs of words; of trigrams only those with a character of ``asked``, if given."""
    table = np.zeros((2, SLOTS), np.int64)
    words: Counter = Counter()
    held: list[str] = []
    known = None if asked is None else np.isin(np.arange(0x110000), np.array([ord(c) for c in asked], np.int64))

    def add() -> None:
        keys = _trigrams("".join(held))
        if known is not None:
            cp = [(keys >> np.uint64(s)) & np.uint64(0x1FFFFF) for s in (42, 21, 0)]
            keys = keys[known[cp[0]] | known[cp[1]] | known[cp[2]]]
        for row, at in zip(table, _slots(keys)):
            np.add(row, np.bincount(at, minlength=SLOTS), out=row)
        held.clear()

    size = 0
    for text in texts:
        held.append(folded(text))  # with edges of their own, so texts can be joined
        size += len(text)
        if size > 2_000_000:
            add()
            size = 0
        words.update(WORD.findall(text))
        words.update(HYPHENED.findall(text))
        words.update(f"{a} {b}" for a, b in _pairs(text))
    if held:
        add()
    if words:
        at = _slots(np.fromiter((_word_key(w) for w in words), np.uint64, len(words)))
        n = np.fromiter(words.values(), np.int64, len(words))
        for row, a in zip(table, at):
            np.add.at(row, a, n)
    return table


def learn_rates(pairs: dict[tuple[str, str], int], seen_true: dict[str, int], least: int = 2) -> dict[tuple[str, str], float]:
    """Rates of the confusions found at least so often, from alignment counts and the true strings' occurrences in the proofread texts."""
    return {(a, b): min(0.5, n / max(n, seen_true.get(b, 1))) for (a, b), n in pairs.items() if n >= least}


class Channel:
    """Rates of confusions, seen string to true strings."""

    def __init__(self, rates: dict[tuple[str, str], float]):
        self.rates = dict(rates)
        for seen, true in CONFUSIONS.items():
            self.rates.setdefault((seen, true), PRIOR_RATE)
        self.true: dict[str, list[str]] = defaultdict(list)
        for seen, true in sorted(self.rates):
            self.true[seen].append(true)
        self.han = {s: t for s, t in self.true.items() if HAN.match(s)}
        self.latin = {s: t for s, t in self.true.items() if not HAN.match(s)}
        #: Characters of the trigrams that can be asked for: those of confusions, and digits and the letters like them.
        self.asked = "".join(sorted({c for pair in self.rates if HAN.match(pair[0]) for x in pair for c in x} | set("0lIOoSB")))
        self.doubtful = re.compile("|".join(map(re.escape, sorted(self.han, key=lambda s: (-len(s), s)))) or "(?!)")


def align(seen: str, true: str) -> Iterator[tuple[str, str]]:
    """Short substitutions between a recognised text and its proofread form."""
    a, b = re.sub(r"\s", "", seen), re.sub(r"\s", "", true)
    for op, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        x, y = a[i:j], b[k:m]
        if op == "replace" and len(x) <= 2 and len(y) <= 2 and not UNREADABLE.search(x) and len(x) * len(y) < 4:
            yield x, y


class Reader:
    def __init__(self, table: np.ndarray, channel: Channel):
        self.table, self.channel = table, channel
        self.words: dict[str, list[tuple[str, float]]] = {}
        self.spots: dict[tuple[str, str, str], tuple[str, int]] = {}  # what was decided, as the same places come again

    def count(self, keys: list[int]) -> list[int]:
        a, b = _slots(np.array(keys, np.uint64))
        return np.minimum(self.table[0][a], self.table[1][b]).tolist()

    def known(self, word: str) -> int:
        return self.count([_word_key(word)])[0]

    def trigram(self, *texts: str) -> list[int]:
        return self.count([(ord(t[0]) << 42) | (ord(t[1]) << 21) | ord(t[2]) for t in texts])

    def _windows(self, left: str, mid: str, right: str) -> list[int]:
        s = left + mid + right
        return self.trigram(*(s[i : i + 3] for i in range(len(s) - 2)))

    def han(self, text: str) -> tuple[str, int]:
        """Viterbi over the doubtful places: neighbouring places that share a trigram are decoded together."""
        places = [m.span() for m in self.channel.doubtful.finditer(text)]
        if not places:
            return text, 0
        pad = folded(text)
        clusters: list[list[tuple[int, int]]] = []
        for span in places:
            if clusters and span[0] - clusters[-1][-1][1] < 2 and not text[clusters[-1][-1][1] : span[0]].isdigit():
                clusters[-1].append(span)
            else:
                clusters.append([span])
        out, at, repaired = [], 0, 0
        for cluster in clusters:
            lo, hi = cluster[0][0], cluster[-1][1]
            left, right = pad[lo : lo + 2], pad[hi + 2 : hi + 4]
            spot = (left, pad[lo + 2 : hi + 2], right)
            if spot not in self.spots:
                if len(self.spots) > 200_000:
                    self.spots.clear()
                self.spots[spot] = self._cluster(left, text, pad, cluster, right)
            best, changed = self.spots[spot]
            out += [text[at:lo], best if changed else text[lo:hi]]
            at = hi
            repaired += changed
        return "".join(out) + text[at:], repaired

    def _cluster(self, left: str, text: str, pad: str, cluster: list[tuple[int, int]], right: str) -> tuple[str, int]:
        """The best reading of neighbouring doubtful places and how many of them it changes; none if the odds against the seen one are too small."""
        segments: list[list[tuple[str, int, float]]] = []
        for k, (i, j) in enumerate(cluster):
            if k:
                segments.append([(pad[cluster[k - 1][1] + 2 : i + 2], 0, 0.0)])
            seen = text[i:j]
            segments.append([(seen, 0, 0.0), *((t, 1, math.log(self.channel.rates[seen, t])) for t in self.channel.han[seen])])
        segments.append([(right, 0, 0.0)])
        base = self._seen(left, segments)
        best, gain, changed = "", MARGIN, 0
        for p, n, odds in self._readings(left, segments):
            if odds - base > gain:
                best, gain, changed = p[: len(p) - len(right)], odds - base, n
        return best, changed

    def _seen(self, left: str, segments: list[list[tuple[str, int, float]]]) -> float:
        """Log likelihood of the seen reading; each count is freed of the noise that the true strings at one place would cause."""
        seen = [s[0][0] for s in segments]
        own = self._windows(left, "".join(seen), "")
        places = [k for k, s in enumerate(segments) if len(s) > 1]
        rivals = [(k, t) for k in places for t, _, _ in segments[k][1:]]
        rate = {k: SAFETY * max(max(PRIOR_RATE, self.channel.rates.get((seen[k], t), PRIOR_RATE)) for t, _, _ in segments[k][1:]) for k in places}
        for k, t in rivals:
            theirs = self._windows(left, "".join([*seen[:k], t, *seen[k + 1 :]]), "")
            n = min(len(own), len(theirs))
            own = [max(0.0, o - rate[k] * x) for o, x in zip(own[:n], theirs[:n])] + own[n:]
        return sum(math.log(n + 0.02) for n in own) / max(1, len(own)) * 3

    def _readings(self, left: str, segments: list[list[tuple[str, int, float]]]) -> Iterator[tuple[str, int, float]]:
        """For each length of the whole, the best reading that changes a place, with its log likelihood and channel: Viterbi with the last two characters and the length so far as state.

        The likelihood is the windows' mean, times three; with the number of windows given, that is a sum over steps.
        """
        logs: dict[str, float] = {}
        lengths = {0}
        for s in segments:
            lengths = {n + len(o) for n in lengths for o, _, _ in s}
        tails = {left}
        for s in segments:  # all windows first, so that counts are looked up together
            nxt = set()
            for tail in tails:
                for o, _, _ in s:
                    t = tail + o
                    logs.update(dict.fromkeys((t[i : i + 3] for i in range(len(t) - 2)), 0.0))
                    nxt.add(t[-2:])
            tails = nxt
        for w, n in zip(list(logs), self.trigram(*logs)):
            logs[w] = math.log(n + 0.02)
        for total in sorted(lengths):
            weight = 3 / max(1, len(left) + total - 2)
            states: dict[tuple[str, int, bool], tuple[float, str, int]] = {(left, 0, False): (0.0, "", 0)}
            for s in segments:
                new: dict[tuple[str, int, bool], tuple[float, str, int]] = {}
                for (tail, n, any_), (score, path, k) in states.items():
                    for o, r, c in s:
                        t = tail + o
                        at = (t[-2:], n + len(o), any_ or r > 0)
                        x = score + c + weight * sum(logs[t[i : i + 3]] for i in range(len(t) - 2))
                        if n + len(o) <= total and (at not in new or x > new[at][0]):
                            new[at] = (x, path + o, k + r)
                states = new
            ends = [v for (_, n, any_), v in states.items() if any_ and n == total]
            if ends:
                score, path, k = max(ends)
                yield path, k, score

    def candidates(self, word: str) -> list[tuple[str, float]]:
        """Words that one or two confusions could have made this one of, with their log odds against it; a word that has to be repaired comes without itself."""
        hit = self.words.get(word)
        if hit is None:
            if len(self.words) > 200_000:
                self.words.clear()
            hit = self.words[word] = self._candidates(word)
        return hit

    def _candidates(self, word: str) -> list[tuple[str, float]]:
        if word.isdigit() or not 2 <= len(word) <= LONGEST_WORD:
            return []
        if re.fullmatch("[0-9lIOoSB]+", word) and re.search("[0-9]", word):
            return [(word.translate(DIGITS_SEEN), math.inf)]
        found: dict[str, float] = {}
        edge = {word: 0.0}
        for _ in range(2):
            new: dict[str, float] = {}
            for w, c in edge.items():
                for seen, trues in self.channel.latin.items():
                    at = w.find(seen)
                    while at >= 0:
                        for t in trues:
                            v, cost = w[:at] + t + w[at + len(seen) :], c + math.log(self.channel.rates[seen, t])
                            if v not in found or cost > found[v]:
                                found[v] = new[v] = cost
                        at = w.find(seen, at + 1)
            edge = new
        found.pop(word, None)
        if not found:
            return []
        names = list(found)
        n = self.count([_word_key(w) for w in [word, *names]])
        own = n[0]
        mixed = bool(re.search(r"[0-9]", word) and re.search(r"[A-Za-z]", word))
        out = []
        for w, k in zip(names, n[1:]):
            if k > 0 and (w.isdigit() or not re.search(r"[0-9]", w)):
                free = max(0.0, own - SAFETY * k * max(WORD_NOISE, math.exp(found[w])))
                out.append((w, math.log((k + 0.01) / (free + 0.05)) + found[w] + (6.0 if mixed else 0.0)))
        if mixed and re.search(r"[A-Za-zÀ-ſ]{2}", word) and not any(o > MARGIN for _, o in out):
            plain = max((w for w in names if w.isalpha()), key=lambda w: found[w], default=None)
            if plain:
                return [(plain, math.inf)]
        return out

    def latin(self, text: str) -> tuple[str, int]:
        """Viterbi over the candidate words of each chain of neighbouring words: own odds, less the margin, and what pairs of words say."""
        words = list(WORD.finditer(text))
        options = [self.candidates(m[0]) for m in words]
        if not any(options):
            return text, 0
        out, at, repaired, i = [], 0, 0, 0
        while i < len(words):
            j = i + 1
            while j < len(words) and words[j].start() == words[j - 1].end() + 1 and text[words[j].start() - 1] == " ":
                j += 1
            if any(options[i:j]):
                for m, w in zip(words[i:j], self._chain([m[0] for m in words[i:j]], options[i:j])):
                    if w != m[0]:
                        out += [text[at : m.start()], w]
                        at = m.end()
                        repaired += 1
            i = j
        return "".join(out) + text[at:], repaired

    def _chain(self, words: list[str], options: list[list[tuple[str, float]]]) -> list[str]:
        lattice = [[(o[0][0], 0.0)] if o and o[0][1] == math.inf else [(w, 0.0), *((v, x - MARGIN) for v, x in o)] for w, o in zip(words, options)]
        pairs = [(a, b) for s, t in zip(lattice, lattice[1:]) if len(s) > 1 or len(t) > 1 for a, _ in s for b, _ in t]
        said = dict(zip(pairs, self.count([_word_key(f"{a} {b}") for a, b in pairs]))) if pairs else {}
        best = {w: (x, [w]) for w, x in lattice[0]}
        for step in lattice[1:]:
            new = {}
            for w, x in step:
                score, path = max(((s + CONTEXT * math.log1p(said.get((a, w), 0)), p) for a, (s, p) in best.items()), key=lambda y: y[0])
                new[w] = (score + x, [*path, w])
            best = new
        return max(best.values(), key=lambda y: y[0])[1]

    def single(self, text: str) -> tuple[str, int]:
        """A letter alone where the text's contexts have numbers: between characters that mostly stand beside digits."""
        n, pad = 0, folded(text)

        def fix(m: re.Match) -> str:
            nonlocal n
            l, r = pad[m.start() : m.start() + 2], pad[m.end() + 2 : m.end() + 4]
            letter, digit = self._windows(l, m[0], r), self._windows(l, "0", r)
            if sum(digit) > 8 * sum(letter):
                n += 1
                return m[0].translate(DIGITS_SEEN)
            return m[0]

        return re.sub(r"(?<![A-Za-zÀ-ſ0-9])[lIOoSB](?![A-Za-zÀ-ſ0-9])", fix, text), n

    def read(self, text: str) -> tuple[str, int]:
        """The repaired text and the number of misrecognised or unreadable places; unreadable ones stay as one sign."""
        wrong = len(UNREADABLE.findall(text))
        text, n = self.han(text)
        wrong += n
        text, n = self.single(text)
        wrong += n

        text, n = self.latin(text)
        return unicodedata.normalize("NFC", text), wrong + n
