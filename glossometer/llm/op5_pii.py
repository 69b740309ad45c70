"""Personal data, with offset-preserving deobfuscation.

Three transducers rewrite a text's disguises, one after the other: glyphs (homoglyphs, full-width, mathematical and other
compatible forms to ASCII, characters without width to nothing), digits (spelled ones of four languages to digits, letters
inside long numbers too), and signs ("at" and "dot" and what they are called in German, French and Spanish, in brackets or
quotes, encoded, between words or underscores, or set apart by blanks, to a mark for each kind). Each is a regular
rewriting rule, compiled to one pattern that is run from left to right, and each keeps for every character that it writes
the span of source characters that it stands for. Identifiers are found in the plain text and, where a disguise was
undone, in the rewritten one, whose spans are mapped back to the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches, unused

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Runs of digits and full stops; every four numbers in a row are a candidate.
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Letters of other scripts that look like ASCII letters.
LOOKALIKES = {
    "а": "a", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ѕ": "s", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Υ": "Y", "Ζ": "Z",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "\u00a0": " ", "\u2009": " ", "\u202f": " ",
}
#: Characters without width: they hide in words and are left out.
WIDTHLESS = "\u00ad\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\ufeff"
#: Marks of the signs transducer: bracketed at, bare at, bracketed dot, bare dot, full stop set apart. Where the source has them they become blanks.
AT, BARE_AT, DOT, BARE_DOT, FAR_DOT = MARKS = "\ue000\ue001\ue002\ue003\ue004"


def compatible() -> dict[str, str]:
    """Characters that Unicode's compatibility forms make one ASCII character, and decimal digits of other scripts."""
    out = {}
    for i in (*range(0x80, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)):
        c = chr(i)
        plain = unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and " " < plain < "\x7f":
            out[c] = plain
        elif (d := unicodedata.decimal(c, None)) is not None:
            out[c] = str(d)
    return out


GLYPHS = compatible() | LOOKALIKES | dict.fromkeys(MARKS, " ") | dict.fromkeys(WIDTHLESS, "")
GLYPH = re.compile("[" + "".join(map(re.escape, GLYPHS)) + "]")
#: The same in two parts: sets of 16-bit characters are looked up in a table, larger ones one after the other.
GLYPH_SETS = (re.compile("[" + "".join(re.escape(c) for c in GLYPHS if c <= "\uffff") + "]"), re.compile("[\U0001d400-\U0001d7ff\U0001f100-\U0001f1ff]"))
#: Digits as words, in English, German, French and Spanish, and words that repeat the digit behind them.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
REPEATS = {"double": 2, "doppel": 2, "doble": 2, "triple": 3}
_DIGIT_WORD = "(?:(?:(?:" + "|".join(REPEATS) + ")[ -])?(?:" + "|".join(SPELLED) + "|[0-9]))"
#: Four or more digits in a row of which some are words; a plus sign and full stops may be words too.
SPELLED_RUN = re.compile(rf"(?i)(?<![\w])(?:(?:plus|más)[ ]+)?{_DIGIT_WORD}(?:(?:[ .-]{{1,2}}|[ ](?:dot|punkt|point|punto)[ ]){_DIGIT_WORD}){{3,}}(?![\w])")
SPELLED_WORD = re.compile(r"(?i)(?:plus|más)[ ]+|[^\W\d_]+(?:[ -]{1,2}(?=\w))?|[0-9](?:[ ](?=[^\W\d_]))?")
LETTER, LETTERS = re.compile(r"[^\W\d_]"), re.compile(r"[^\W\d_]+")
#: A number of eight places or more in which letters may stand for digits, and those letters.
LETTERED = re.compile(r"(?<![A-Za-z0-9])[+(]?[0-9lIOo(][0-9lIOo ().-]{6,40}[0-9lIOo](?![A-Za-z0-9])")
AS_DIGIT = {"l": "1", "I": "1", "O": "0", "o": "0"}
#: Digits that such a number has at least beside its letters, of which it has no more than a third as many.
LEAST_DIGITS = 7
#: Endings of host names that a "dot" as a bare word may stand before: all of countries, and common generic ones.
COUNTRIES = (
    "ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bw by bz ca cc cd cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz "
    "ec ee eg er es et eu fi fj fk fm fo fr ga gd ge gf gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn kp kr kw ky kz "
    "la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa "
    "re ro rs ru rw sa sb sc sd se sg sh si sj sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw"
)
GENERIC = (
    "com org net edu gov mil int info biz name pro mobi coop aero asia cat jobs museum post tel travel xxx xyz top app dev page web wiki blog online site website space store shop tech technology software digital "
    "cloud email host hosting network systems solutions services support agency company business group team work works consulting marketing media news press live life world global today club community social center "
    "zone link click vip one fun games game art design studio photo photos photography gallery video film music academy school education university science health care clinic law legal finance bank money capital fund "
    "foundation church city house land hotel restaurant cafe bar berlin hamburg koeln cologne bayern wien london scot wales paris amsterdam brussels swiss tokyo nyc"
)
ENDINGS = frozenset((COUNTRIES + " " + GENERIC).split())
#: Words before a "dot" that is a thing and no sign, as in "look at the dot in the middle".
THINGS = frozenset("the a an this that each every any one no another my your his her its our their which what".split())
#: Words before a bare "at" that is a preposition, as in "meet us at example dot com".
PLACED = frozenset(
    "us me him her them it you here there now meet met stay stayed staying stays arrive arrived arriving arrives look looked looking looks be been being is are was were am live lived lives living work worked works working "
    "sit sat stand stood wait waited waiting aim aimed aiming back only even just still again found find seen bought sold laugh laughed start started starts end ended ends open opens opened read more join joined visit visited not and or but all"
    .split()
)
#: What has to be there before a text's signs are looked at; begins with a set of characters, which is fast to look for.
SIGNED = re.compile(r"(?i)[\[({<\"'][ ]*(?:at|ät|@|dot|punkt|point|punto|\.)[ ]*[\])}>\"']|[ ]@|@[ ]|[ _-](?:dot|punkt|point|punto)[ _-]|[&%](?:#0*64;|#x0*40;|commat;|40|#0*46;|#x0*2e;|period;|2e)|@[^\s@]*[ ]+\.[ ]")
_IN, _OUT = r"(?<![ ])[ ]*[\[({<\"'][ ]*", r"[ ]*[\])}>\"'][ ]*"
_AFTER, _BEFORE = r"(?<=[A-Za-z0-9_%+-])", r"(?=[A-Za-z0-9_%+-])"
#: Signs as words in the four languages, and encoded.
_AT_WORD, _DOT_WORD = "(?:at|ät|arobase|arrobase|arroba|klammeraffe)", "(?:dot|punkt|point|punto)"
_AT_CODE, _DOT_CODE = "&#0*64;|&#x0*40;|&commat;|%40", "&#0*46;|&#x0*2e;|&period;|%2e"
#: The signs transducer: a group for each mark.
SIGN = re.compile(
    rf"(?i)({_IN}(?:{_AT_WORD}|@){_OUT}|(?<![ ])[ ]+@[ ]*|@[ ]+|{_AT_CODE})|({_AFTER}(?:[ ]+{_AT_WORD}[ ]+|[_-]at[_-]){_BEFORE})|({_IN}(?:{_DOT_WORD}|\.){_OUT}|{_DOT_CODE})|({_AFTER}(?:[ ]+{_DOT_WORD}[ ]+|[_-]dot[_-]){_BEFORE})|({_AFTER}[ ]+\.[ ]+{_BEFORE})"
)
#: "point" is a word of English prose too: it is a sign only so near an at that isn't an English word.
POINT, FOREIGN_AT, NEAR_POINT = re.compile("(?i)[ ]point[ ]"), re.compile(r"(?i)@|[ ](?:arr?obase|ät)[ ]|[\[({<\"'][ ]*(?:at|arr?obase)[ ]*[\])}>\"']|&#|%40"), 80
SIGN_AT = re.compile(f"[@{AT}{BARE_AT}]")
HOST = re.compile(f"[A-Za-z0-9-]+(?:[.{DOT}{BARE_DOT}{FAR_DOT}][A-Za-z0-9-]+)+")
SEPARATOR = re.compile(f"[.{DOT}{BARE_DOT}{FAR_DOT}]")
LAST_WORD = re.compile(r"[A-Za-z]+\Z")
#: Marks in a text that numbers are looked for in.
NUMERIC = str.maketrans({AT: " ", BARE_AT: " ", DOT: ".", BARE_DOT: ".", FAR_DOT: " "})
#: A spelled number of so many words may be a phone number without a plus sign.
SPELLED_PHONE = 7


class Mapped(NamedTuple):
    """A text and, for each of its characters, the source span that it stands for; starts is None where both are the source itself."""

    text: str
    starts: list[int] | None = None
    ends: list[int] | None = None

    def source(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.starts is None else (self.starts[start], self.ends[end - 1])

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace spans, given from the left; each new character stands for its whole span, or for its own part if the lengths agree."""
        if not edits:
            return self
        starts, ends = (list(range(len(self.text))), list(range(1, len(self.text) + 1))) if self.starts is None else (self.starts, self.ends)
        text, new_starts, new_ends, at = [], [], [], 0
        for start, end, new in edits:
            text += [self.text[at:start], new]
            new_starts += starts[at:start]
            new_ends += ends[at:start]
            if len(new) == end - start:
                new_starts += starts[start:end]
                new_ends += ends[start:end]
            else:
                new_starts += [starts[start]] * len(new)
                new_ends += [ends[end - 1]] * len(new)
            at = end
        return Mapped("".join([*text, self.text[at:]]), new_starts + starts[at:], new_ends + ends[at:])


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping: the run of local characters before each @, but for what a match before took."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        elif start < at:
            free = max(free, at)  # nothing before this @ can begin a later match
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts = [(m.start() + run.start(), m.end() + run.start(), m.group()) for m in re.finditer("[0-9]+", run.group())]
        for i in range(0, len(parts) - 3, 4):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for *_, p in parts[i : i + 4]):
                yield parts[i][0], parts[i + 3][1]


def luhn(digits: str) -> bool:
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m.group())) <= 15:
            yield m.span()


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """Spans in code points by kind, then start."""
    if not DIGIT.search(text):
        return [("email", *span) for span in emails(text)]
    return [(kind, *span) for kind, find in FINDERS.items() for span in find(text)]


def plain_glyphs(m: Mapped) -> Mapped:
    if m.text.isascii():
        return m
    glyph = GLYPH if GLYPH_SETS[1].search(m.text) else GLYPH_SETS[0]
    found = [(x.start(), x.end(), GLYPHS[x.group()]) for x in glyph.finditer(m.text)]
    if m.starts is None and all(len(new) == 1 for *_, new in found):  # the places stay
        return Mapped(glyph.sub(lambda x: GLYPHS[x.group()], m.text)) if found else m
    return m.rewrite(found)


def lettered_numbers(m: Mapped) -> Mapped:
    """Letters that stand for digits in long numbers, as in 0l23."""
    edits = []
    for x in LETTERED.finditer(m.text) if DIGIT.search(m.text) else ():
        letters = [i for i in range(*x.span()) if m.text[i] in AS_DIGIT]
        if letters and len(DIGIT.findall(x.group())) >= max(LEAST_DIGITS, 3 * len(letters)):
            edits += [(i, i + 1, AS_DIGIT[m.text[i]]) for i in letters]
    return m.rewrite(edits)


def plain_digits(m: Mapped) -> tuple[Mapped, list[tuple[int, int]]]:
    """The rewritten text, and the source spans of wholly spelled phone numbers: 9 to 15 digits, not counting up, and no card."""
    edits, phones = [], []
    for run in SPELLED_RUN.finditer(m.text):
        if not LETTER.search(run.group()):
            continue
        said, times, start = [], 1, None
        for x in SPELLED_WORD.finditer(m.text, *run.span()):
            word = x.group().strip(" -").lower()
            start = x.start() if start is None else start
            if word in REPEATS:
                times = REPEATS[word]
                continue
            said.append({"plus": "+", "más": "+", "dot": ".", "punkt": ".", "point": ".", "punto": "."}.get(word) or SPELLED.get(word, word) * times)
            edits.append((start, x.end(), said[-1]))
            times, start = 1, None
        number = "".join(said)
        counting = all((int(b) - int(a)) % 10 == 1 for a, b in zip(number, number[1:])) if number.isdigit() else False
        if number.isdigit() and 9 <= len(number) <= 15 and not counting and len(LETTERS.findall(run.group())) >= SPELLED_PHONE and not (len(number) >= 13 and luhn(number)):
            phones.append(m.source(*run.span()))
    return m.rewrite(edits), phones


def marked_signs(m: Mapped) -> Mapped:
    if not SIGNED.search(m.text):
        return m
    there = lambda x: not POINT.fullmatch(x.group()) or FOREIGN_AT.search(m.text, max(0, x.start() - NEAR_POINT), x.end() + NEAR_POINT)
    return m.rewrite([(x.start(), x.end(), MARKS[x.lastindex - 1]) for x in SIGN.finditer(m.text) if there(x)])


def host_end(text: str, at: int, sign: str) -> int | None:
    """Where the host that begins at `at` ends, if there is one. sign: the at before it; a bare word needs a spelled dot behind it.

    Full stops that are set apart don't mix with others; behind them, behind a bare dot and behind a bare at the host has
    to end in a known ending, and behind another disguised at in a word.
    """
    bare = sign == BARE_AT
    found = HOST.match(text, at)
    if not found:
        return None
    dots, end = [(x.start(), x.group()) for x in SEPARATOR.finditer(text, at, found.end())], found.end()
    far = [i for i, (_, d) in enumerate(dots) if d == FAR_DOT]
    if far and (bare or len(far) < len(dots)):
        dots, end = dots[: far[0]], dots[far[0]][0]
    spelled = next((i for i, (_, d) in enumerate(dots) if d in DOT + BARE_DOT), len(dots))
    if bare and (spelled == len(dots) or (dots[spelled][1] == BARE_DOT and text[at : dots[spelled][0]].lower() in THINGS)):
        return None
    for i in range(len(dots) - 1, spelled - 1 if bare else -1, -1):  # from the longest host
        place, kind = dots[i]
        ending = text[place + 1 : end].lower()
        if ending in ENDINGS or ending.startswith("xn--") or (not bare and kind in "." + DOT and (sign == "@" or ending.isalpha())):
            return end
        end = place
    return None


def marked_emails(text: str) -> Iterator[tuple[int, int]]:
    """As emails, in a text with marks. A bare dot goes on with the local part unless a word that makes it a thing stands before it."""
    free = 0
    for sign in SIGN_AT.finditer(text):
        at = sign.start()
        start = at
        while start > free:
            c = text[start - 1]
            if c == BARE_DOT and (w := LAST_WORD.search(text, max(free, start - 9), start - 1)) and w.group().lower() in THINGS:
                break
            if not (c in LOCAL or c in DOT + BARE_DOT):
                break
            start -= 1
        while start < at and text[start] in DOT + BARE_DOT:
            start += 1
        if sign.group() == BARE_AT and text[start:at].lower() in PLACED:
            continue
        end = host_end(text, at + 1, sign.group()) if start < at else None
        if end:
            yield start, end
        free = max(free, end or (at if start < at and sign.group() != BARE_AT else 0))


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) of the source: those of the text as it is, and those of its deobfuscated form, but for
    what equals or lies inside one of their kind. A span that contains base spans goes beside them."""
    text = text or ""
    base = identifiers(text)
    m, spelled = plain_digits(lettered_numbers(plain_glyphs(Mapped(text))))
    m = marked_signs(m)
    if m.text == text:
        return base, base
    numeric = m.text.translate(NUMERIC)
    found = [("email", *m.source(*x)) for x in marked_emails(m.text)]
    if DIGIT.search(numeric):
        found += [(kind, *m.source(*x)) for kind in KINDS[1:] for x in FINDERS[kind](numeric)]
        found += [("phone", *x) for x in spelled]
    own = {kind: [x[1:] for x in base if x[0] == kind] for kind in KINDS}
    more, free = [], dict.fromkeys(KINDS, 0)
    for kind, s, e in sorted(found, key=lambda x: (x[1], -x[2])):
        at = bisect_right(own[kind], (s, len(text)))  # base spans are in order and don't overlap: the last that begins at s or before is the only one that can hold the span
        if s >= free[kind] and (not at or own[kind][at - 1][1] < e):
            free[kind] = e
            more.append((kind, s, e))
    return base, sorted([*base, *more], key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def said(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone (base spans), base_sha256, and spans: all spans as kind:start:end.

    Null and empty texts hold nothing. Rows are independent, so repeated ids and rows, null ids and an empty table need
    no rule. Long runs of one kind of character cost linear time. Other columns stay; those of the names above are
    replaced.
    """
    text_batches(docs.sparkSession)
    added = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                base, spans = find(text)
                kinds = [k for k, *_ in base]
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(said(base).encode()).hexdigest(), said(spans)))
            yield pd.DataFrame(rows, columns=added)

    found = F.pandas_udf(run, ", ".join(f"{c} {'long' if c[:2] == 'n_' else 'string'}" for c in added))
    rows, own = docs.drop(*added), unused("found", docs)
    return rows.withColumn(own, found(F.col(text_col))).select(*(F.col(f"`{c}`") for c in rows.columns), *(F.col(own)[c].alias(c) for c in added))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
