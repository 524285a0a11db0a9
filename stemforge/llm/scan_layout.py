"""Page furniture and line structure of text from scanned pages."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

NUM = r"(?:[0-9０-９]{1,4}|[零〇一二三四五六七八九十百]{1,6})"
# Words that papers print in running headers and footers.
CUES = [
    "學年度", "年", "考科", "試題", "題本", "卷別", "第", "頁", "共", "全", "考", "科", "試卷", "背面尚有試題", "請翻頁繼續作答", "翻頁", "請勿攜出", "續背面", "背面",
    "page", "pages", "of", "paper", "turn over", "turn over the page", "please turn over", "english", "continued on next page",
]
#: A furniture line holds one of these; numbers and names alone may be text.
STRONG = r"學年度|考科|試題|題本|卷別|頁|考\s*科|試卷|請勿攜出|‖|(?i:page|paper|turn over)"
MARKS = r"[\s　/／‖|－\-–—～~・·:：（）()〈〉《》\[\]]"
# Subjects and exams whose names appear in headers where a table gives none.
NAMES = ["國文", "英文", "數學", "社會", "自然", "法學", "資訊", "會考", "學測", "分科", "檢定", "指考", "模考"]

PAGE_NO = re.compile(rf"^[\s　]*(?:第[\s　]*{NUM}[\s　]*頁|(?i:p(?:age|g)?\.?)[\s　]*{NUM}|[-－–—～~〈《（(\[]+[\s　]*{NUM}[\s　]*[-－–—～~〉》）)\]]+|[0-9０-９]{{1,3}}[\s　]*[/／][\s　]*[0-9０-９]{{1,3}}|[0-9０-９]{{1,3}})[\s　]*$")
LIST_ITEM = re.compile(r"^[\s　]*(?:[（(][一二三四五六七八九十甲乙丙丁戊A-Za-z0-9]{1,3}[）)]|[甲乙丙丁戊己庚辛壬癸一二三四五六七八九十]{1,2}、|[①-⑳]|[0-9A-Za-z]{1,2}[.．、)]\s*\S)")
ENDS = re.compile(r"[。？！?!.][」』”\"）)]*$")
SPLIT_HYPHENS = "-‐¬­‑"


class Furniture:
    """Runs of furniture: numbers, cue words, names of subjects and exams (also spaced out), marks and blanks, in any order.

    A run's ends are found by walking words' tries from every place reached, so the work is linear in the run's length
    and doesn't grow with the number of names.
    """

    def __init__(self, names: Iterable[str] = ()):
        self.single = re.compile(rf"[0-9０-９零〇一二三四五六七八九十百]|{MARKS}")
        self.names, self.cues = {}, {}
        for trie, words in ((self.names, {n for n in names if n} | set(NAMES)), (self.cues, CUES)):
            for w in words:
                node = trie
                for ch in w.lower():
                    node = node.setdefault(ch, {})
                node[""] = {}

    @staticmethod
    def _walk(text: str, at: int, trie: dict, spaced: bool) -> Iterator[int]:
        node, i = trie, at
        while i < len(text):
            if spaced and i > at and text[i] in " 　\t" and text[i] not in node:
                i += 1
                if i == len(text):
                    return
            node = node.get(text[i].lower())
            if node is None:
                return
            i += 1
            if "" in node:
                yield i

    def ends(self, text: str, at: int = 0) -> set[int]:
        """All places where a run that begins at the given one may end."""
        reached, todo = set(), [at]
        while todo:
            i = todo.pop()
            if i >= len(text):
                continue
            steps = [*self._walk(text, i, self.names, True), *self._walk(text, i, self.cues, False)]
            if self.single.match(text, i):
                steps.append(i + 1)
            for j in steps:
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        return reached

    def fullmatch(self, text: str) -> bool:
        return len(text) in self.ends(text)


@dataclass
class Parsed:
    """lines: the text's own lines in order; seams: for each line after the first, how it goes on: hyphen, break or end."""

    lines: list[str] = field(default_factory=list)
    headers: list[str] = field(default_factory=list)
    pages: list[str] = field(default_factory=list)


def is_header(line: str, furniture: Furniture) -> bool:
    s = line.strip(" 　\t")
    return bool(s) and re.search(STRONG, s) is not None and furniture.fullmatch(s)


#: What a run inside a line must hold to be furniture rather than words of the text.
INLINE = re.compile(rf"學年度|考[\s　]?科|試題|題本|卷別|請勿攜出|翻頁|‖|頁[\s　]*[/／]?[\s　]*共|(?i:turn over)|(?i:page)\s*{NUM}\s*(?i:of)|(?i:paper)\s*{NUM}")
_BLANKS = re.compile(r"([\s　]+)")
_PHRASE = re.compile(rf"(?i:(?:please )?turn over(?: the page)?|page\s+{NUM}\s+of\s+{NUM}|paper\s+{NUM})")
_NUMBER = re.compile(NUM)


def cut_inline(line: str, furniture: Furniture) -> tuple[str, list[str]]:
    """Furniture inside a line: the longest runs of whole blank-separated segments that are furniture together."""
    if not INLINE.search(line):
        return line, []
    line = _PHRASE.sub(lambda m: _BLANKS.sub("\0", m[0]), line)
    parts = _BLANKS.split(line)  # segments at even places, blanks between
    plain = [x.replace("\0", " ") for x in parts]
    start = [0]
    for x in plain:
        start.append(start[-1] + len(x))
    whole = "".join(plain)
    found, out, i = [], "", 0
    idle: set[int] = set()  # places within runs that hold nothing to cut, so that each run is walked once
    fits = lambda a, b: b > a and INLINE.search(whole, start[a], start[b]) is not None and furniture.fullmatch(whole[start[a] : start[b]])
    while i < len(parts):
        end = 0
        if i % 2 == 0 and parts[i] and start[i] not in idle and (len(parts[i]) == 1 or furniture.fullmatch(plain[i])):
            ends = furniture.ends(whole, start[i])
            j, cands, last = i + 1, [], max(ends, default=0)
            while j <= len(parts) and start[j] <= last:
                if j % 2 == 1 and start[j] in ends:
                    cands.append(j)
                j += 1
            held = INLINE.search(whole, start[i], start[cands[-1]]) if cands else None  # what the longest run lacks, shorter ones lack too
            end = cands[-1] if held else 0
            if not end:
                idle |= ends
            while end and end - i > 2 and _NUMBER.fullmatch(parts[end - 1]) and start[end - 2] in ends and (start[end - 2] >= held.end() or INLINE.search(whole, start[i], start[end - 2])):
                end -= 2
            if end and _NUMBER.fullmatch(parts[i]) and re.match(NUM, parts[min(i + 2, len(parts) - 1)]) and fits(i + 2, end):
                end = 0
        if end:
            found.append(whole[start[i] : start[end]])
            out = out.rstrip(" 　")
            after = "".join(parts[end:]).lstrip(" 　")
            if out and after and out[-1].isascii() and after[0].isascii() and (out[-1].isalpha() or after[0].isalpha()):
                out += " "
            i = end + 1
        else:
            out += plain[i]
            i += 1
    return out, found


def parse(text: str, furniture: Furniture) -> Parsed:
    p = Parsed()
    for raw in re.split(r"\r\n|\r|\n", text):
        if not raw.strip(" 　\t"):
            continue
        if PAGE_NO.match(raw):
            p.pages.append(raw.strip())
        elif is_header(raw, furniture):
            p.headers.append(raw.strip())
        else:
            line, inline = cut_inline(raw, furniture)
            p.headers += inline
            if line.strip(" 　\t"):
                p.lines.append(line.strip(" 　\t"))
    return p


_LETTER = r"A-Za-zÀ-ſ"
#: Characters at the end of a text that decide how it goes on.
TAIL = 256


def seams(lines: list[str], known) -> tuple[str, set[str]]:
    """The continuous text of the lines, and the kinds of seams in it. known(word) is how often a word occurs within lines."""
    if not lines:
        return "", set()
    # What is decided depends on the end of the text so far, so long texts are joined in linear time.
    pieces, tail, kinds = [lines[0]], lines[0][-TAIL:], set()
    listed = bool(LIST_ITEM.match(lines[0]))
    for nxt in lines[1:]:
        m = re.search(rf"([{_LETTER}0-9]+)([{re.escape(SPLIT_HYPHENS)}])$", tail)
        n = re.match(rf"[{_LETTER}0-9]+", nxt)
        between = ""
        if m and n:
            hyphened, whole = f"{m[1]}-{n[0]}", m[1] + n[0]
            if m[2] in "-‐‑" and known(hyphened) > 3 * known(whole):
                kinds.add("break")
            else:
                kinds.add("hyphen")
                pieces[-1], tail = pieces[-1][:-1], tail[:-1]
        elif ENDS.search(tail) and (LIST_ITEM.match(nxt) or listed) or LIST_ITEM.match(nxt) and tail.endswith((":", "：", "；", ";")):
            between = "\n"
        else:
            if not ENDS.search(tail):
                kinds.add("break")
            if re.search(rf"[{_LETTER}0-9,;:.?!)]$", tail) and re.match(rf"[{_LETTER}0-9(]", nxt) and re.search(rf"[{_LETTER}]", tail[-12:] + nxt[:12]):
                between = " "
        pieces += [between, nxt]
        tail = (tail + between + nxt)[-TAIL:]
        listed = listed or bool(LIST_ITEM.match(nxt))
    return "".join(pieces), kinds
