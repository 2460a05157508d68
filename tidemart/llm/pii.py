"""Personal data with source offsets, also where it is disguised.

Four kinds are found in the text as it stands (``plain_spans``). Then a chain of small transducers
rewrites the text, each keeping for every character the source span it came from:

* characters that look like ASCII ones become those; invisible characters go,
* letters that stand for digits inside or next to numbers become digits,
* "(at)" and "[dot]" become "@" and ".", and so do "%40" and "&#64;" of links and pages,
* spelled digits ("four oh double-one", in four languages) become digits, "plus" a plus sign, "dot" between numbers a dot,
* "name at host dot com" becomes "name@host.com".

Long runs of spelled digits are read twice, once as they are separated and once without what separates them. The same detectors run on the rewritten text, and what they find goes back to source characters.
A span found so is added if some of its characters were rewritten and it is no plain span. It may contain or overlap plain
ones, which stay.

Null and empty texts have no spans. Offsets count code points, ends are exclusive. Every row is
looked at on its own, so there is no shuffle, and repeated rows give repeated results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DIGIT = re.compile(r"[0-9]")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])+")
CALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, str]


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Linear in the text: only the characters next to an "@" are looked at."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        free = at + 1
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", free)


def addresses(text: str) -> Iterable[tuple[int, int]]:
    """Four numbers of a dotted run make one match; a match with a part over 255 is used up as well."""
    for run in DOTTED.finditer(text):
        parts, start = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(twice)) % 10 == 0


def cards(text: str) -> Iterable[tuple[int, int]]:
    for m in GROUPED.finditer(text):
        if m.end() - m.start() < 12:
            continue
        digits = NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterable[tuple[int, int]]:
    for m in CALLED.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


DETECTORS = dict(zip(KINDS, (emails, addresses, cards, phones), strict=True))


def plain_spans(text: str) -> list[Span]:
    """Spans of the text as it stands, by start, then kind."""
    kinds = KINDS if DIGIT.search(text) else ("email",)
    return by_place((a, b, kind) for kind in kinds for a, b in DETECTORS[kind](text))


def by_place(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# --- transducers -------------------------------------------------------------------------------

# Characters that look like ASCII ones (Cyrillic, Greek, punctuation); one for one.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s",
    "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H",
    "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E",
    "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X",
    "\u0131": "i", "\u0261": "g", "\u2024": ".", "\u3002": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-",
    "\u2212": "-", "\u00a0": " ", "\u2009": " ", "\u202f": " ",
}
FULL_WIDTH = {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
ARABIC_DIGITS = {chr(base + d): str(d) for base in (0x660, 0x6F0, 0x966) for d in range(10)}
LOOKS = str.maketrans({**FULL_WIDTH, **ARABIC_DIGITS, **LOOKALIKES})
LOOKING = re.compile("[" + re.escape("".join(map(chr, LOOKS))) + "]")
INVISIBLE = re.compile("[­​-‏⁠﻿]")

# Digit words of English, French, German and Spanish (without those that are also articles).
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8",
    "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
REPEATS = {"double": 2, "triple": 3}
ANY_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
ONE = rf"(?:(?:double|triple)[ -])?(?:{ANY_DIGIT}|[0-9])"
SPELLED = re.compile(rf"(?<!\w)(?:plus[ ,]+)?(?:(?:double|triple)[ -])?(?:{ANY_DIGIT})(?:[ ,.-]{{1,2}}{ONE}){{6,}}(?!\w)", re.I)
SPELLED_SOME = {word.encode() for word in DIGIT_WORDS}
SPELLED_BYTES = bytes(c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() or c == 0x5F else 0x20 for c in range(256))
SPELLED_PART = re.compile(rf"plus|double|triple|{ANY_DIGIT}|[0-9]", re.I)
# Groups of digits and letters like them. A group without a digit stands between others, or is tied to one by "." or "-".
LOOSE = re.compile(r"(?<![A-Za-z0-9])[0-9OolI]++(?![A-Za-z])(?:[ .()-]{1,3}[0-9OolI]++(?![A-Za-z]))*+")
LOOSE_PART = re.compile(r"([0-9OolI]+)")
LOOSE_HINT = re.compile(r"[0-9][ .()-]{0,3}[OolI]++(?![A-Za-z])|[OolI][ .()-]{0,3}[0-9]|\+[OolI]")
# Words of several languages that consist of such letters.
LOOSE_WORDS = {"il", "io", "ill", "lo", "lol", "ol", "oo"}
LETTER_DIGITS = str.maketrans("OolI", "0011")

AT_WORDS = "at|arroba|arobase|ät"
DOT_WORDS = "dot|punto|point|punkt"
# How addresses in links and pages write "@" and ".".
ENCODED = re.compile("(?P<at>%40|&#64;|&#x40;|&commat;)|%2e|&#46;|&#x2e;|&period;", re.I)
ENCODED_AT = re.compile("%40|&#64;|&#x40;|&commat;", re.I)
BRACKET = re.compile(r"[\[({<]")
BRACKETED = re.compile(rf"[ ]?[\[({{<][ ]?(?:(?P<at>{AT_WORDS}|@)|(?:{DOT_WORDS}|\.))[ ]?[\])}}>][ ]?", re.I)
# Any letters may be the last label. Words that are no host or, being no top-level domain, no last label.
NO_HOST = "the|a|an|this|that|these|those|each|every|any|some|one|my|your|his|her|its|our|their|which|what"
NO_END = "of|and|or|the|for|with|from|where|when|that|which|if|but|was|were|are|has|had|he|she|they|we|you|then|than|because|on|an"
SPOKEN_HOST = re.compile(
    rf"(?P<at> (?:{AT_WORDS}) )(?!(?:{NO_HOST}) )[A-Za-z0-9-]++(?:(?: (?:{DOT_WORDS}) |\.)[A-Za-z0-9-]++)* (?:{DOT_WORDS}) "
    rf"(?!(?:{NO_END}|{DOT_WORDS})(?!\w))[A-Za-z]{{2,}}+(?!\w)",
    re.I,
)
LOCAL_PART = re.compile(r"[A-Za-z0-9_%+-]+")
LOCAL_START = re.compile(r"(?<![\w.])[A-Za-z0-9]")
LONGEST_DOT = max(map(len, DOT_WORDS.split("|"))) + 2
# Number parts, spelled or not, and what separates them. A spoken dot, or a literal one between spaces, is a dot.
NUMBER = rf"(?:(?:double|triple)[ -])?(?:{ANY_DIGIT}|[0-9]++)(?!\w)"
BETWEEN = rf"(?: (?:{DOT_WORDS}) |[ ,.()-]{{1,4}})"
CHAIN = re.compile(rf"(?<!\w)(?:plus[ ,]+|\+ ?)?\(?{NUMBER}(?:{BETWEEN}{NUMBER})+", re.I)
CHAIN_PART = re.compile(rf"(?P<plus>plus[ ,]+)|(?P<times>double|triple)[ -]|(?P<word>{ANY_DIGIT})|(?P<digits>[0-9]+)", re.I)
NUMBER_DOT = re.compile(rf"[0-9] (?:{DOT_WORDS}) [0-9]", re.I)
FEWEST_DIGITS = 4
SPOKEN_DOT = re.compile(rf" (?:{DOT_WORDS}) ", re.I)
SPOKEN_HINT = re.compile(rf" (?:{AT_WORDS}) [^ ]+ (?:{DOT_WORDS}) ", re.I)


class Mapped(NamedTuple):
    """Text with the source span of every character."""

    text: str
    starts: Sequence[int]
    ends: Sequence[int]

    def rewrite(self, edits: Iterable[tuple[int, int, str]]) -> Mapped:
        """Replace spans, in order, each by one character or none. A character stands for its whole span."""
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += (self.text[at:a], new)
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            if new:
                starts.append(self.starts[a])
                ends.append(self.ends[b - 1])
            at = b
        if not at:
            return self
        return Mapped("".join([*text, self.text[at:]]), [*starts, *self.starts[at:]], [*ends, *self.ends[at:]])


def number_edits(text: str) -> Iterable[tuple[int, int, str]]:
    """One edit for each digit of a long spelled number; what stands between its words goes."""
    for run in SPELLED.finditer(text):
        at, times = run.start(), 1
        for part in SPELLED_PART.finditer(text, run.start(), run.end()):
            word = part[0].lower()
            if word in REPEATS:
                times = REPEATS[word]
                continue
            digit = "+" if word == "plus" else DIGIT_WORDS.get(word, word)
            if at < part.start() and times == 1:
                yield at, part.start(), ""
                at = part.start()
            # Of a repeated digit, each copy but the last stands for a character of what comes before it.
            for k in range(times - 1):
                yield at + k, at + k + 1, digit
            yield at + times - 1, part.end(), digit
            at, times = part.end(), 1


def chain_edits(text: str) -> Iterable[tuple[int, int, str]]:
    """Spelled digits and spoken dots of every chain of number parts; literal dots, hyphens and brackets stay."""
    for run in CHAIN.finditer(text):
        edits, digits, times, start, before = [], 0, 1, None, None
        for part in CHAIN_PART.finditer(text, run.start(), run.end()):
            if part["plus"]:
                edits.append((*part.span(), "+"))
                continue
            at = start if start is not None else part.start()
            if before:
                # What separates this part from the one before it.
                end, single = before
                between = text[end:at]
                alone = part["digits"] is None or len(part["digits"]) == 1
                spelled = part["digits"] is None or text[end - 1] not in "0123456789"
                if between == " . " or SPOKEN_DOT.fullmatch(between):
                    edits.append((end, at, "."))
                elif not between.strip(" ,") and single and alone and spelled:
                    edits.append((end, at, ""))
                elif "," in between and spelled:
                    edits.append((end, at, " "))
            before = None
            if part["times"]:
                times, start = REPEATS[part["times"].lower()], part.start()
                continue
            digit = part["digits"] or DIGIT_WORDS[part["word"].lower()]
            if part["word"] or times > 1:
                # Of a repeated digit, each copy but the last stands for a character of what comes before it.
                edits += [(at + k, at + k + 1, digit[0]) for k in range(times - 1)]
                edits.append((at + times - 1, part.start() + 1 if part["digits"] else part.end(), digit[0]))
            digits += times - 1 + len(digit)
            before, times, start = (part.end(), len(digit) == 1), 1, None
        if digits >= FEWEST_DIGITS:
            yield from edits


def as_digits(run: re.Match) -> str:
    """The groups of a run with letters read as digits where they belong to a number."""
    if not DIGIT.search(run[0]) or run[0].isdigit():
        return run[0]
    cut = LOOSE_PART.split(run[0])
    called = run.string[max(0, run.start() - 1) : run.start()] == "+"
    for i in range(1, len(cut), 2):
        left, right = i > 1 or called, i < len(cut) - 2
        tied = i > 1 and cut[i - 1] in (".", "-") or right and cut[i + 1] in (".", "-")
        longer = len(cut[i]) > 1 and cut[i].lower() not in LOOSE_WORDS
        if DIGIT.search(cut[i]) or left and right or tied or longer:
            cut[i] = cut[i].translate(LETTER_DIGITS)
    return "".join(cut)


def spoken_local(text: str, parts: list[tuple[int, int]], free: int, at: int) -> int | None:
    """Where the name before a spoken "at" begins, no earlier than ``free``: parts tied by dots, spoken or not.

    ``parts`` are all runs of name characters in the text.
    """
    i = bisect_left(parts, at, key=lambda part: part[1])
    if i == len(parts) or parts[i][1] != at:
        return None
    named = []
    while parts[i][1] > free:
        named.append((max(free, parts[i][0]), parts[i][1]))
        if i > 0 and text[parts[i - 1][1] : parts[i][0]] == ".":
            i -= 1
        elif i > 1 and parts[i][0] - parts[i - 2][1] <= LONGEST_DOT and SPOKEN_DOT.fullmatch(text, parts[i - 2][1], parts[i][0]):
            i -= 2
        else:
            break
    return next((m.start() for part in reversed(named) if (m := LOCAL_START.search(text, *part))), None)


def spoken_edits(text: str) -> Iterable[tuple[int, int, str]]:
    """Linear in the text: every host after an "at" is looked for first, then the name between it and what came before."""
    free, m = 0, SPOKEN_HOST.search(text)
    parts = [part.span() for part in LOCAL_PART.finditer(text)] if m else []
    while m:
        start = spoken_local(text, parts, free, m.start())
        if start is None:
            m = SPOKEN_HOST.search(text, m.end("at") - 1)
            continue
        free = m.end()
        yield from ((*dot.span(), ".") for dot in SPOKEN_DOT.finditer(text, start, m.start()))
        yield *m.span("at"), "@"
        yield from ((*dot.span(), ".") for dot in SPOKEN_DOT.finditer(text, m.end("at"), m.end()))
        m = SPOKEN_HOST.search(text, free)


def has_spelled_digit(text: str) -> bool:
    return not SPELLED_SOME.isdisjoint(text.encode("utf-8", "replace").translate(SPELLED_BYTES).split())


def deobfuscate(text: str) -> list[Mapped]:
    """The rewritten texts, none if no transducer has anything to do."""
    plain = text.isascii()
    shown = text if plain or not LOOKING.search(text) else text.translate(LOOKS)
    hidden = not plain and INVISIBLE.search(shown)
    rules: list[Callable] = []
    if hidden:
        rules.append(lambda t: ((*m.span(), "") for m in INVISIBLE.finditer(t)))
    if ENCODED_AT.search(shown):
        rules.append(lambda t: ((*m.span(), "@" if m["at"] else ".") for m in ENCODED.finditer(t)))
    bracketed = BRACKET.search(shown) and BRACKETED.search(shown)
    if hidden or bracketed:
        rules.append(lambda t: ((*m.span(), "@" if m["at"] else ".") for m in BRACKETED.finditer(t)))
    numbers = hidden or has_spelled_digit(shown) or NUMBER_DOT.search(shown)
    spoken = hidden or SPOKEN_HINT.search(shown)
    loose = hidden or LOOSE_HINT.search(shown)
    if not rules and not numbers and not spoken and not loose and shown is text:
        return []
    mapped = Mapped(shown, range(len(text)), range(1, len(text) + 1))
    for rule in rules:
        mapped = mapped.rewrite(rule(mapped.text))
    if loose:
        mapped = mapped._replace(text=LOOSE.sub(as_digits, mapped.text))
    out = []
    for rule in (chain_edits, number_edits) if numbers else (None,):
        read = mapped.rewrite(rule(mapped.text)) if rule else mapped
        if spoken:
            read = read.rewrite(spoken_edits(read.text))
        if read.text != text and all(read.text != r.text for r in out):
            out.append(read)
    return out


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and those that only the rewritten texts show."""
    base = plain_spans(text)
    taken, added = set(base), []
    for mapped in deobfuscate(text):
        for a, b, kind in plain_spans(mapped.text):
            start, end = mapped.starts[a], mapped.ends[b - 1]
            if text[start:end] != mapped.text[a:b] and (start, end, kind) not in taken:
                added.append((start, end, kind))
                taken.add((start, end, kind))
    return base, added


def redact(text: str, spans: Iterable[Span]) -> str:
    """Replace every span, or joined stretch of spans, by its kind in angle brackets."""
    out, at = [], 0
    for a, b, kind in by_place(spans):
        if a >= at:
            out += (text[at:a], f"<{kind.upper()}>")
        at = max(at, b)
    return "".join([*out, text[at:]])


# --- Spark -------------------------------------------------------------------------------------

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())])
FOUND = T.StructType(
    [
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("kind", T.StringType()),
                        T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType()),
                        T.StructField("plain", T.BooleanType()),
                    ]
                )
            ),
        ),
        T.StructField("redacted", T.StringType()),
    ]
)


@F.arrow_udf(FOUND)
def personal_data(texts: pa.Array) -> pa.Array:
    """Spans in order, and the text with all of them replaced (null if there are none)."""
    found, shown = [], []
    for text in texts.to_pylist():
        base, added = find_spans(text) if text else ([], [])
        plain = set(base)
        every = by_place([*base, *added])
        found.append([{"kind": k, "start": a, "end": b, "plain": (a, b, k) in plain} for a, b, k in every])
        shown.append(redact(text, every) if every else None)
    return pa.StructArray.from_arrays([pa.array(found, pa.list_(SPAN)), pa.array(shown, pa.string())], ["spans", "redacted"])


def with_personal_data(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Add the column ``out`` (spans, redacted); a column of that name is replaced."""
    return docs.withColumn(out, personal_data(F.col(text)))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their personal data replaced; the columns stay as they are."""
    columns = docs.columns
    found = docs.withColumn("__pii", personal_data(F.col(text)))
    return found.withColumn(text, F.coalesce("__pii.redacted", text)).select(*columns)


def joined(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_report(docs: DataFrame) -> DataFrame:
    """op1: counts and digest of the plain spans, and all spans as text, of every document."""
    found = with_personal_data(docs.select("doc_id", "text"))
    plain = F.filter("pii.spans", lambda s: s["plain"])
    counts = [count_of(plain, kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(plain), 256).alias("base_sha256"), joined(F.col("pii.spans")).alias("spans")
    )
