"""Text rules as Spark columns: normalisation, lint predicates, option and answer shapes.

All are null-in, null-out unless stated, and use Java regular expressions, which run in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CJK = r"　-〿㐀-䶿一-鿿＀-￯"
HAN = r"一-鿿"

# Words of the lint rules.
FIGURE_WORDS = "如圖|下圖|附圖|圖中|圖一|圖二|圖示|右圖|左圖|下表|附表"
FOLLOW_UP_WORDS = "承上題|承前題|上題中|前題"
NEGATIVE_WORDS = "何者錯誤|何者有誤|何者不正確|何者不適當|不正確的是|錯誤的是"
HEDGE_WORDS = "信心|把握|可信度"
LEVEL_WORDS = "高|中|低|不足|有限"
GAP_WORDS = "看不到|未提供|為空|無法核對|缺圖|未附"
BOILERPLATE = "僅供參考|以上解析|如有疑義|請以官方"
#: Full-width letters and digits of answers, and their half-width forms.
WIDE = "ＡＢＣＤＥＦＧＨＩＪ０１２３４５６７８９"
NARROW = "ABCDEFGHIJ0123456789"
FURNITURE_WORDS = "考科|試題|題本|卷別|翻頁|^ *第[ 0-9]+頁[ \r]*$"

squeeze = lambda c: F.regexp_replace(c, r"(?U)\s+", "")
fold_answer = lambda c: F.translate(c, WIDE, NARROW)


def join_clean(c: Column) -> Column:
    """Blanks of all kinds to one, then none between two wide characters."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), f"(?<=[{CJK}]) (?=[{CJK}])", ""))


def full_width_marks(c: Column) -> Column:
    """Half-width marks that follow an ideograph become full-width; a point only where no other follows. Idempotent."""
    for half, full in ((",", "，"), (";", "；"), (":", "："), ("!", "！"), ("?", "？")):
        c = F.regexp_replace(c, f"(?<=[{HAN}])\\{half}", full)
    return F.regexp_replace(c, rf"(?<=[{HAN}])\.(?!\.)", "。")


def half_width_separators(c: Column) -> Column:
    """Full-width separators between Latin letters or digits become half-width."""
    for full, half in (("／", "/"), ("，", ","), ("－", "-"), ("．", ".")):
        c = F.regexp_replace(c, f"(?<=[A-Za-z0-9]){full}(?=[A-Za-z0-9])", half)
    return c


def tidy_gates(c: Column) -> Column:
    """The ordered repair gates: literal line ends, single to double line ends between paragraphs, marks. Idempotent."""
    c = F.replace(c, F.lit("\\n"), F.lit("\n"))
    c = F.regexp_replace(c, r"\r\n?", "\n")
    c = F.regexp_replace(c, r"(?<!\n)\n(?!\n)", "\n\n")
    return full_width_marks(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def paragraphs_or_same(c: Column) -> Column:
    """Single line ends become paragraph breaks where every line but the last ends like a sentence, so that a line is a paragraph; a text whose structure isn't recognised stays as it is."""
    lines = F.filter(F.split(c, "\n"), lambda x: F.trim(x) != "")
    known = F.forall(F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: x.rlike("[。！？：；][\\s　]*$"))
    return F.when(known, F.array_join(lines, "\n\n")).otherwise(c)


def safe_name(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"[^0-9A-Za-z_一-鿿]+", "_"), F.lit("_"))


def roc_date(c: Column) -> Column:
    """ISO date of a date in years of the Republic (民國 112 年 3 月 5 日); null if there is none."""
    part = lambda i: F.nullif(F.regexp_extract(c, r"(\d{2,3})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日", i), F.lit("")).cast("int")
    return F.try_make_date(part(1) + 1911, part(2), part(3)) if hasattr(F, "try_make_date") else F.make_date(part(1) + 1911, part(2), part(3))


def scaled_number(value: Column, scale: Column) -> Column:
    """Plain decimal text of a number with thousands commas and a scale sign (千, 萬, 億)."""
    factor = F.when(scale == "千", 1_000).when(scale == "萬", 10_000).when(scale == "億", 100_000_000).otherwise(1)
    text = (F.replace(value, F.lit(","), F.lit("")).cast("decimal(20,6)") * factor).cast("decimal(32,6)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def visible_text(c: Column) -> Column:
    """HTML without scripts, styles and tags; common entities decoded, blanks collapsed."""
    c = F.regexp_replace(c, r"(?is)<(script|style|noscript)\b.*?</\1>", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]*>", "\n")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))  # the ampersand last, so that nothing is decoded twice
    return F.regexp_replace(F.regexp_replace(c, r"[ \t]*\n\s*", "\n"), r"^\s+|\s+$", "")


def prompt_digest(c: Column, mask: str | None = None) -> Column:
    """First 16 hex digits of the SHA-256 of the text without trailing blanks of lines; ``mask`` stands for a path that may differ."""
    if mask:
        c = F.replace(c, F.lit(mask), F.lit("<OUT>"))
    return F.substring(F.sha2(F.array_join(F.transform(F.split(F.trim(c), "\n"), lambda x: F.rtrim(x)), "\n"), 256), 1, 16)


def html_safe_json(c: Column) -> Column:
    return F.replace(c, F.lit("</"), F.lit("<\\/"))


# --- predicates -----------------------------------------------------------------------------------------------------


def option_texts(options: Column) -> Column:
    return F.coalesce(F.map_values(options), F.array().cast("array<string>"))


def needs_figure(stem: Column, passage: Column, options: Column) -> Column:
    """The text speaks of a figure, or the options are too few or all empty, as they are when they are drawn."""
    values = option_texts(options)
    text = F.concat_ws(" ", stem, passage)
    return text.rlike(FIGURE_WORDS) | ((F.size(values) > 0) & (F.size(values) < 4)) | ((F.size(values) > 0) & F.forall(values, lambda o: F.trim(F.coalesce(o, F.lit(""))) == ""))


def ends_like_sentence(c: Column) -> Column:
    return c.rlike(r"[。？！?!:：」][\s　]*$")


def map_terms(c: Column, terms: dict[str, str]) -> Column:
    """Terms of the mapping replaced; any other stays as it is."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in terms.items() for x in pair]), c), c)


def furniture_line(c: Column) -> Column:
    return c.rlike(FURNITURE_WORDS)


def without_furniture(c: Column) -> Column:
    """The text without its furniture lines."""
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~furniture_line(x)), "\n")


def concluded_letters(c: Column) -> Column:
    """The letters that an explanation concludes with (故選), else those it names as the answer; '' without any."""
    said = F.regexp_extract(c, r"故選[ 　]*[(（]?([A-J]+)", 1)
    return F.when(said != "", said).otherwise(F.regexp_extract(c, r"^正解：[(（]([A-J]+)[)）]", 1))


def without_boilerplate(c: Column) -> Column:
    """Without a disclaimer at the end that is short and has no letters, digits or articles; elsewhere it stays."""
    return F.regexp_replace(c, rf"[^。\nA-Za-z0-9第]{{0,40}}(?:{BOILERPLATE})[^。\nA-Za-z0-9第]{{0,40}}。?\s*$", "")


def repeated_mark(c: Column) -> Column:
    """The same circled mark twice, with no other between."""
    return c.rlike(r"([①-⑩])[^①-⑩]*\1")


def text_after_question(c: Column) -> Column:
    return c.rlike("？[^？\n）」 　\r]")


def bare_latex(c: Column) -> Column:
    """Formulas set as LaTeX that have only digits, signs and charges, which plain sub- and superscripts can show."""
    return F.filter(F.regexp_extract_all(c, F.lit(r"\\\(\s*(.+?)\s*\\\)"), F.lit(1)), lambda x: x.rlike(r"^(?:\\times|[\d\s.,=＝+\-×÷/^{}])+$"))


def basis_of(basis: Column, evidence: Column, fields: Column, rationale: Column) -> Column:
    """A content_error whose evidence field isn't in the payload, or that speaks of something it couldn't see, is an input_gap."""
    gap = ~F.coalesce(F.array_contains(fields, evidence), F.lit(False)) | F.coalesce(rationale.rlike(GAP_WORDS), F.lit(False))
    return F.when((basis == "content_error") & gap, "input_gap").otherwise(basis)


def multiset_within(part: Column, whole: Column) -> Column:
    """Each character of ``part`` is there at least as often in ``whole``."""
    signs = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    n = lambda c, x: F.length(c) - F.length(F.replace(c, x, F.lit("")))
    return F.forall(F.array_distinct(signs(part)), lambda x: n(part, x) <= n(whole, x))


def locate(page: Column, needle: Column, longest: int = 30, unique: int = 10, least: int = 6) -> Column:
    """STRUCT<chars, at>: the longest beginning of the needle, of 30 to 10 characters, that is on the page once; else of 30 to 6, at its first place. Blanks don't count."""
    p, n = squeeze(page), squeeze(needle)
    top = F.least(F.length(n), F.lit(longest))
    tries = lambda lo: F.when(top >= lo, F.sequence(top, F.lit(lo), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    at = lambda k: F.instr(p, F.substring(n, F.lit(1), k))
    once = F.filter(tries(unique), lambda k: (at(k) > 0) & (F.instr(F.substring(p, at(k) + 1, F.length(p)), F.substring(n, F.lit(1), k)) == 0))
    any_ = F.filter(tries(least), lambda k: at(k) > 0)
    k = F.coalesce(F.get(once, 0), F.get(any_, 0))
    return F.struct(k.alias("chars"), F.when(k.isNotNull(), at(k)).alias("at"))


def marks_in_order(markers: Column) -> Column:
    """Option marks are A, B, C ... without gap or repetition."""
    return markers == F.slice(F.split(F.lit("ABCDEFGHIJ"), ""), 1, F.size(markers))


def quotes_balance(c: Column) -> Column:
    return F.regexp_count(c, F.lit("「")) == F.regexp_count(c, F.lit("」"))


def anomalous_signs(c: Column) -> Column:
    """How many private-use and compatibility characters a text has."""
    return F.regexp_count(c, F.lit(r"[-豈-﫿]"))


def half_marks_beside_han(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"[{HAN}][,;:?!]"))


def structure_faults(c: Column) -> Column:
    """Faults of an explanation's structure: three sections apart by blank lines, the answer first, the points last."""
    parts = F.split(F.regexp_replace(c, r"\r\n", "\n"), r"\n{2,}")
    rules = (("sections", F.size(parts) != 3), ("head", ~F.element_at(parts, 1).startswith("正解：")), ("tail", ~F.element_at(parts, -1).startswith("本題考點：")))
    return F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]), lambda x: x.isNotNull())


def wrong_letters(options: Column, answer: Column) -> Column:
    """Letters that a single-choice explanation has to discuss: the options without the answer's."""
    return F.array_sort(F.array_except(F.map_keys(options), F.filter(F.split(answer, ""), lambda x: x != "")))


#: Letters in the forms that option letters are written in (full width, Greek, Cyrillic), and A to J.
LETTERS_SEEN = "ＡＢＣＤＥＦＧＨＩＪΑΒΕΗΙАВСЕНІЈ"
LETTERS = "ABCDEFGHIJABEHIABCEHIJ"
#: A letter in brackets, or one that heads a line.
DISCUSSED = r"([(（][ 　]*[A-J][ 　]*[)）]|(?:^|[\r\n])[ 　]*[A-J][ 　]*[：:])"


def explanation_body(c: Column) -> Column:
    """Without the first line, which names the answer, and the last section, which lists the points."""
    return F.regexp_replace(F.regexp_replace(c, r"^[ 　\r\n]*[^\r\n]+", ""), r"[\r\n][ 　\r\n]*本題考點[：:][\s\S]*$", "")


def discussed_letters(c: Column) -> Column:
    found = F.regexp_extract_all(F.translate(c, LETTERS_SEEN, LETTERS), F.lit(DISCUSSED), 1)
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, "[^A-J]", ""))))


def answer_letters(c: Column) -> Column:
    return F.array_sort(F.regexp_extract_all(F.coalesce(fold_answer(c), F.lit("")), F.lit("([A-J])"), 1))


def question_type(answer: Column, options: Column) -> Column:
    """非選 without letters, 多選 with several, else 單選."""
    none = F.coalesce(F.size(options), F.lit(0)) <= 0
    a = F.coalesce(fold_answer(answer), F.lit(""))
    return F.when((a == "／") | ((a == "") & none), "非選").when(F.size(answer_letters(answer)) > 1, "多選").otherwise("單選")


def domain_by_words(text: Column, words: dict[str, list[str]]) -> Column:
    """The domain with the most hits of its words; '' on a tie or without hits."""
    count = lambda w: (F.length(text) - F.length(F.replace(text, F.lit(w), F.lit("")))) / len(w)
    hits = [(sum((count(w) for w in ws), F.lit(0.0)), d) for d, ws in words.items()]
    top = F.greatest(*[h for h, _ in hits])
    ties = sum((F.when(h == top, 1).otherwise(0) for h, _ in hits), F.lit(0))
    best = F.lit("")
    for h, d in hits:
        best = F.when(h == top, d).otherwise(best)
    return F.when((top > 0) & (ties == 1), best).otherwise("")


def split_options(segment: Column) -> Column:
    """Map of option letter to text in a segment written as stem (A) ... (B) ...; the first of a repeated letter counts."""
    letters = F.regexp_extract_all(segment, F.lit(r"\(([A-E])\)"), 1)
    texts = F.transform(F.slice(F.split(segment, r"\([A-E]\)"), 2, 1_000), lambda x: F.trim(x))
    pairs = F.transform(letters, lambda x, i: F.struct(x.alias("k"), F.get(texts, i).alias("v")))
    first = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, 1, i), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(first)


def cut_option_tail(c: Column) -> Column:
    """Without the next question that ran into an option's end."""
    return F.regexp_replace(c, r"(?s)\s\d+\s*[.．]\s*\S.*$", "")


def stem_fingerprint(stem: Column) -> Column:
    return F.sha2(squeeze(stem), 256)


def content_fingerprint(stem: Column, options: Column) -> Column:
    """Stem and sorted options without blanks."""
    values = F.array_sort(F.transform(option_texts(options), lambda o: squeeze(F.coalesce(o, F.lit("")))))
    return F.sha2(F.concat(squeeze(stem), F.lit("\u0001"), F.array_join(values, "\u0001")), 256)


def full_fingerprint(stem: Column, options: Column, answer: Column, passage: Column) -> Column:
    return F.sha2(F.concat_ws("\u0002", content_fingerprint(stem, options), F.coalesce(answer, F.lit("")), squeeze(F.coalesce(passage, F.lit("")))), 256)
