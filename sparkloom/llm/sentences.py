"""Sentence boundaries in several languages and scripts (problem 8).

Tables of ordered rules, one table for each language: a rule is (break or not, pattern before,
pattern after), and at each candidate position (after a final mark with what closes it) the first
rule that matches decides. A paragraph's cascade joins the tables of all languages of the scripts
that it holds, so paragraphs in another language than the document's are split by their own rules;
the column lang isn't needed. Quotations, brackets and code are found first and never broken.

Defined cases: null, empty and blank texts have no rows; positions count code points; any line end
(\\n, \\r\\n, \\r) is a line break; brackets and quotes that never close within their paragraph are
ordinary characters.
"""

from __future__ import annotations

import bisect
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame

GAP = r"(?=\s|$)"
WORD = r"(?<![\p{L}\p{M}\p{N}'’])(?<!\p{L}\.(?=\p{Ll}))"
# a word in lower case that is no identifier, name of a module or file, and no keyword that may open a sentence
LOWER = r"(?=\s+(?!lp\b)\p{Ll}[\p{Ll}\p{M}'’‑-]*(?![\p{L}\p{N}_(])(?!\.\p{Ll}))"
NUMBER = r"(?=\s*\p{Nd})"


def _abbreviations(always: str = "", number: str = "", lower: str = "", end: str = "") -> list[tuple[bool, str, str]]:
    """Rules for abbreviations: those that never end a sentence, that don't before a number, that
    don't before a word in lower case or a number, and those like etc., which end it before all else."""
    word = lambda names: WORD + "(?:" + "|".join(regex.escape(x).replace(r"\ ", r"\s+") for x in names.split(", ")) + ")"
    out = []
    if always:
        out.append((False, word(always), r"(?=\s)"))
    if number:
        out.append((False, word(number), NUMBER))
    if lower:
        out += [(False, word(lower), LOWER), (False, word(lower), NUMBER)]
    if end:
        out += [(False, word(end), LOWER), (True, word(end), GAP)]
    return out


# Rule tables by language.
RULES: dict[str, list[tuple[bool, str, str]]] = {
    "en": [
        (False, r"\b[ap]\.m\.", r"(?=\s+(?:UTC|GMT|[A-Z]{2,3}T)\b)"),
        *_abbreviations(
            "e.g., i.e., cf., vs., incl., excl., approx., Dept., Mr., Mrs., Ms., Dr., Prof., St., Jr., Sr., Rev., Gen., Gov., Sen., Rep., Capt., Lt., Col., Sgt., viz.",
            "No., no., Nos., nos., p., pp., v., vol., Vol., vols., cl., Sec., sec., Secs., Fig., fig., Figs., figs., Eq., eq., Ver., ver., Ch., ch., Art., art., par., Par., Tab., tab., Jan., Feb., Mar., Apr., Jun., Jul., Aug., Sep., Sept., Oct., Nov., Dec.",
            "max., min., chars., ff., avg., est., dept., ref., resp., temp., no., ed., eds., misc., orig., sec., a.m., p.m., U.S., U.K.",
            "etc., et al.",
        ),
    ],
    "de": [
        (False, r"(?i:\b(?:am|im|der|die|das|den|dem|des|vom|zum|zur|bis|ab|beim|ein|eine|einen|einem|einer|und|oder))\s+\p{Nd}{1,3}\.", r"(?=\s+\p{L})"),
        (False, WORD + r"\p{Nd}{1,3}\.", r"(?=\s+(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Versuch|Lauf|Kapitel|Fassung|Auflage|Jahrhundert)\b)"),
        *_abbreviations(
            "z. B., z.B., d. h., d.h., u. a., u.a., i. d. R., z. T., z.T., o. ä., s. o., s. u., z., d., u., ca., bzw., vgl., Vgl., ggf., evtl., Hr., Fr., Dr., Prof., inkl., exkl., zzgl., sog., insb., allg., St., Str., ehem., gem., lt., entspr., Abt.",
            "Nr., nr., Nrn., Abb., S., Kap., Bd., Tab., Art., Abs., Ziff., Ver., Aufl., Anm., Verf.",
            "max., min., Std., Min., Sek., Mio., Mrd., Tsd., geb., gest., verh.",
            "usw., usf., u. dgl., etc.",
        ),
    ],
    "fr": _abbreviations(
        "p. ex., c.-à-d., cf., Cf., env., M., MM., Mme., Mlle., Dr., Pr., St., Ste., av., apr., boul., éd., p.",
        "fig., Fig., art., Art., p., pp., vol., chap., Chap., n., no., nos., tél., t., sect., al.",
        "max., min., mm., hab., ex., resp., réf.",
        "etc.",
    ),
    "es": _abbreviations(
        "p. ej., p., ej., Ud., Uds., ud., uds., Vd., Vds., Sr., Sra., Srta., Dr., Dra., D., Dña., Prof., Profa., aprox., Aprox., cf., EE. UU., p.ej.",
        "núm., Núm., núms., n., pág., Pág., págs., fig., Fig., cap., Cap., art., Art., vol., sec., tel., t.",
        "máx., mín., Máx., Mín., max., min., av., Avda., depto., admón., izq., dcha.",
        "etc.",
    ),
    "ru": _abbreviations(
        "т. е., т.е., т. к., т. н., т., напр., Напр., см., См., ср., Ср., др., г-н., им., проф., акад., тов., просп., ул.",
        "рис., Рис., стр., Стр., с., гл., Гл., табл., Табл., п., пп., ст., разд., ч., кн., изд., № .",
        "тыс., млн., млрд., руб., коп., мин., сек., макс., ок., прим., ред., г., гг., в., вв.",
        "и т. д., и т.д., и т. п., и др., и пр., т. д., т. п.",
    ),
    "el": [
        (True, r"[;;]", r"(?=\s+\P{Ll}|\s*$)"),
        (False, r"[;;]", r""),
        *_abbreviations("δηλ., βλ., Βλ., π.χ., Π.χ., κ., κα., Δρ., καθ., μ.Χ., π.Χ.", "εικ., Εικ., σελ., Σελ., κεφ., Κεφ., αρ., Αρ., πίν., άρθρ., παρ.", "περ., μέγ., ελάχ., αι., εκ.", "κ.λπ., κλπ., κ.ά., κ.τ.λ., κτλ., κ.ο.κ."),
    ],
    "zh": [(True, r"[。！？｡．]", r""), (False, r"…", r"(?=[\p{Han}\p{L}\p{N}“‘「（《])"), (True, r"[\p{Han}\p{Hiragana}\p{Katakana}\p{N}\p{L}”」』）％%][!?]+", r"(?=[\p{Han}\p{Hiragana}\p{Katakana}「『“（《`\p{L}\p{N}])")],
    "ja": [(True, r"[。！？｡．]", r""), (False, r"…", r"(?=[\p{Han}\p{Hiragana}\p{Katakana}\p{L}\p{N}「『（])")],
    "hi": [(True, r"[।॥]", r""), *_abbreviations("डॉ., श्री., प्रो., सं., कं., रु.", "पृ., क्र.")],
    "ar": [(True, r"[؟۔]", GAP), *_abbreviations("د., أ., م.", "ص., ج., ط., رقم.")],
    "th": [*_abbreviations("พ.ศ., ค.ศ., น., ดร., นาย., ม.ค., ก.พ., เช่น.", "น., ข้อ., หน้า.")],
    # for all: what follows decides
    "all": [
        (True, r"[\p{Ll}\p{M}]{2}[.!?]", r"(?=\p{Lu}|[“„«(])"),
        (False, r"", r"(?=\s*[—–―,;:،؛、，；：](?:\s|\p{L}|$))"),
        (False, WORD + r"\p{Nd}{1,4}\.", LOWER),
        (False, r"\p{Lu}\.\s?\p{Lu}\.", r"(?=\s+\p{Lu}\p{Ll})"),
        (False, r"", LOWER),
        (True, r"[.!?…؟۔।॥。！？｡．‼⁇⁈⁉]", GAP),
    ],
}

# The languages of each script, in the order of their tables.
SCRIPTS: dict[str, list[tuple[str, ...]]] = {
    "Latin": [("en", "de", "fr", "es")],
    "Cyrillic": [("ru",)],
    "Greek": [("el",)],
    "Han": [("zh",)],
    "Hiragana": [("ja",), ("zh",)],
    "Katakana": [("ja",), ("zh",)],
    "Devanagari": [("hi",)],
    "Arabic": [("ar",)],
    "Thai": [("th",)],
}
_SCRIPT = {s: regex.compile(rf"\p{{{s}}}") for s in SCRIPTS}


@lru_cache(maxsize=1024)
def _table(names: tuple[str, ...], skip: int | None) -> tuple[list[tuple[bool, regex.Pattern, regex.Pattern]], regex.Pattern | None]:
    """Rules of the tables in order; for a number of characters that close the mark, as one pattern, whose last group
    is the number of the first rule that matches."""
    # the pattern before looks at the mark itself; what closes it lies between the mark and the gap
    rules = [(b, f"(?<={before})" if before else "", after) for name in names for b, before, after in RULES[name]]
    if skip is None:
        return [(b, regex.compile(x), regex.compile(y)) for b, x, y in rules], None
    gap = f"(?s:.{{{skip}}})" if skip else ""
    return [(b, None, None) for b, _, _ in rules], regex.compile("|".join(f"{x}{gap}{y}()" for _, x, y in rules))


JOINED = 4  # closing characters for which the rules are joined


def _verdict(tables: list[tuple[str, ...]], text: str, p: int, end: int, hi: int) -> bool | None:
    """What the first rule that matches says of a mark that ends at p and is closed by [p, end)."""
    for names in tables:
        rules, joined = _table(names, end - p if end - p <= JOINED else None)
        if joined is not None:
            if m := joined.match(text, p, hi):
                return rules[m.lastindex - 1][0]
        else:
            for brk, before, after in rules:
                if before.match(text, p, hi) and after.match(text, end, hi):
                    return brk
    return None


MARKS = regex.compile(r"[.!?…؟۔।॥。！？｡．‼⁇⁈⁉;;]+")
REFERENCE = regex.compile(r"\[(?:\p{Nd}{1,4}|\p{Ll})\]")
CODE = regex.compile(r"```.*?```|`(?:[^`\n\r]|\r?\n(?![ \t]*\r?\n))*`", regex.S)
BLANK = regex.compile(r"(?:\r\n|\n|\r)(?:[^\S\r\n]*(?:\r\n|\n|\r))+")
LINE = regex.compile(r"\r\n|\n|\r")
ITEM = regex.compile(r"[^\S\r\n]*(?:[-*+•‣◦–][^\S\r\n]|(\p{Nd}{1,4})[.)．）][^\S\r\n]|([a-zа-яα-ω])\)[^\S\r\n]|\((?:\p{Nd}{1,3}|\p{Ll})\)[^\S\r\n])")
HEAD = regex.compile(r"[^\S\r\n]*#{1,6}[^\S\r\n]")
FRONT = regex.compile(r"\s*(?:[-*+•‣◦–#]+\s+)?(?:\p{Nd}{1,4}[.)．）]|\p{L}\)|\((?:\p{Nd}{1,3}|\p{L})\))(?=\s)")
# Opening characters and what closes them.
PAIRS = {"“": "”", "„": "“”", "«": "»", "‹": "›", '"': '"', "「": "」", "『": "』", "（": "）", "(": ")", "[": "]", "【": "】", "《": "》", "〈": "〉", "〝": "〟", "｢": "｣"}
BRACKETS = "（([【《〈"
CLOSERS: dict[str, str] = {}  # closing character -> openers that it closes
for _o, _cs in PAIRS.items():
    for _c in _cs:
        CLOSERS[_c] = CLOSERS.get(_c, "") + _o
FENCES = regex.compile("[" + regex.escape("".join(dict.fromkeys([*PAIRS, *CLOSERS]))) + "]")
CLOSE = set("”’»›」』）)]】》〉〟｣\"'")
THAI = regex.compile(r"(?<=[ก-ฺเ-๎])[^\S\r\n]+(?=[ก-ฺเ-๎])")
UNCASED = regex.compile(r"\s*[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Arabic}\p{Devanagari}]")


def _spans(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    """Outermost quotations and brackets of a paragraph: one pass with a stack for each kind of opener."""
    waiting: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for m in FENCES.finditer(text, lo, hi):
        c, at = m[0], m.start()
        for op in CLOSERS.get(c, ""):
            if stack := waiting.get(op):
                ends[stack.pop()] = at + 1
        if c in PAIRS:
            waiting.setdefault(c, []).append(at)
    out, at = [], lo
    for s in sorted(ends):
        if s >= at:
            out.append((s, ends[s]))
            at = ends[s]
    return out


def _breaks(text: str, lo: int, hi: int) -> list[int]:
    """Positions within [lo, hi), part of a paragraph, after which a new sentence begins."""
    tables: list[tuple[str, ...]] = []
    for s, own in {"Latin": SCRIPTS["Latin"]}.items() if text[lo:hi].isascii() else SCRIPTS.items():
        if _SCRIPT[s].search(text, lo, hi):
            tables += [t for t in own if t not in tables]
    languages = {n for t in tables for n in t}
    tables.append(("all",))
    spans = _spans(text, lo, hi)
    starts, ends = [s for s, _ in spans], {e - 1: i for i, (_, e) in enumerate(spans)}
    greek = [m.start() for m in _SCRIPT["Greek"].finditer(text, lo, hi)] if "el" in languages else []
    front = FRONT.match(text, lo, hi)
    front_end = front.end() if front else lo
    out, begin = [], lo
    points = [(m.end(), m.start(), m[0]) for m in MARKS.finditer(text, lo, hi)]
    if "th" in languages:
        points = sorted(points + [(m.start(), m.end(), "") for m in THAI.finditer(text, lo, hi)])
    for p, other, mark in points:
        if p <= front_end or p < begin:
            continue
        k = bisect.bisect_right(starts, p - 1) - 1
        inside = k if k >= 0 and spans[k][0] < p and p < spans[k][1] else -1
        if not mark:
            if inside < 0:
                out.append(p)
                begin = p
            continue
        if mark[-1] in ";;" and bisect.bisect_left(greek, begin) >= bisect.bisect_left(greek, p):
            continue
        end = p
        while end < hi:
            if end in ends or text[end] in CLOSE and (end not in starts):
                if text[end] == "'" and end + 1 < hi and text[end + 1].isalnum():
                    break
                end += 1
            elif text[end] == "[" and (r := REFERENCE.match(text, end, hi)):
                end = r.end()
            elif text[end] in "    " and end + 1 < hi and text[end + 1] in "»›" and end + 1 in ends:
                end += 2
            else:
                break
        if inside >= 0:
            s, e = spans[inside]
            if end < e:
                continue
            lead = s - 1
            while lead >= begin and text[lead].isspace():
                lead -= 1
            if text[s] in BRACKETS:
                if lead >= begin:
                    continue
            elif (lead < begin or text[lead] not in ":：") and UNCASED.match(text, end, hi):
                continue
        verdict = _verdict(tables, text, p, end, hi)
        if verdict is None and inside >= 0 and UNCASED.match(text, end, hi):
            verdict = True
        if verdict:
            out.append(end)
            begin = end
    return out


def split(text: str | None) -> list[tuple[int, int]]:
    """Start and end of every sentence of a text."""
    if not text or text.isspace():
        return []
    masked, fences = text, []
    if "`" in text:
        parts, at = [], 0
        for m in CODE.finditer(text):
            fence = m[0].startswith("```") and len(m[0]) > 5
            parts += [text[at : m.start()], "`" + "" * (len(m[0]) - 2) + "`"]
            if fence:
                fences.append((m.start(), m.end()))
            at = m.end()
        masked = "".join(parts) + text[at:]
    cuts = {0, len(text)}
    for s, e in fences:
        cuts |= {s, e}
    for m in BLANK.finditer(masked):
        cuts.add(m.start())
    edges = sorted(cuts)
    done = {s for s, _ in fences}
    out: list[tuple[int, int]] = []

    def add(s: int, e: int) -> None:
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        if s < e:
            out.append((s, e))

    for lo, hi in zip(edges[:-1], edges[1:]):
        if lo in done:
            add(lo, hi)
            continue
        while lo < hi and masked[lo].isspace():
            lo += 1
        # lines: a list item or a heading begins a part of its own
        parts, last = [lo], ITEM.match(masked, lo, hi)
        heads = {lo} if HEAD.match(masked, lo, hi) else set()
        for m in LINE.finditer(masked, lo, hi):
            item = ITEM.match(masked, m.end(), hi)
            if item and item[1] and not (item[1] == "1" or last and last[1] and int(item[1]) == int(last[1]) + 1):
                item = None
            if item and item[2] and not (item[2] in "aаα" or last and last[2] and ord(item[2]) == ord(last[2]) + 1):
                item = None
            if item or HEAD.match(masked, m.end(), hi) or parts[-1] in heads:
                parts.append(m.end())
                if HEAD.match(masked, m.end(), hi):
                    heads.add(m.end())
            last = item or last
        for s, e in zip(parts, [*parts[1:], hi]):
            at = s
            if s not in heads:
                for b in _breaks(masked, s, e):
                    add(at, b)
                    at = b
            add(at, e)
    return out


def sentences(docs: DataFrame) -> DataFrame:
    """doc_id, start_pos, end_pos of every sentence of docs (doc_id, text)."""

    def run(batches):
        for pdf in batches:
            ids, start, end = [], [], []
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                for s, e in split(t):
                    ids.append(i)
                    start.append(s)
                    end.append(e)
                if len(ids) > 200_000:
                    yield pd.DataFrame({"doc_id": ids, "start_pos": start, "end_pos": end})
                    ids, start, end = [], [], []
            yield pd.DataFrame({"doc_id": ids, "start_pos": start, "end_pos": end})

    return docs.select("doc_id", "text").where("text is not null").mapInPandas(run, "doc_id long, start_pos long, end_pos long")
