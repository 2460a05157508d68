import hashlib
import random
import re
import time

import pytest
from tables import ODD_TEXTS, clashing, documents

from tidemart.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


@pytest.mark.parametrize("alphabet", ["a.@1-%2 5", "0123456789 -", "+1234567890 ().-", "0.1.2.5.9.300"])
def test_plain_spans_equal_the_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(5_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert pii.plain_spans(text) == brute(text), text


@pytest.mark.parametrize(
    "text, shown, kind",
    [
        ("mail joe.x (at) host [dot] com now", "joe.x (at) host [dot] com", "email"),
        ("jоe@exаmple.com", "jоe@exаmple.com", "email"),
        ("ｊｏｅ＠example．com", "ｊｏｅ＠example．com", "email"),
        ("write jane dot doe at mail dot example dot com please", "jane dot doe at mail dot example dot com", "email"),
        ("call plus one five five five double-two three four five six seven ok", "plus one five five five double-two three four five six seven", "phone"),
        ("four zero four one eight nine four nine seven four six zero eight seven nine five", None, "card"),
        ("card 4O41894974608795 x", "4O41894974608795", "card"),
        ("j​oe@a​.com", None, "email"),
        ("see ?to=joe.x%40host.com&b=1", "joe.x%40host.com", "email"),
        ("see <b>joe&#64;host&#46;com</b>", "joe&#64;host&#46;com", "email"),
    ],
)
def test_disguises_map_back_to_source_characters(text, shown, kind):
    base, added = pii.find_spans(text)
    assert base == [] and [k for _, _, k in added] == [kind]
    start, end, _ = added[0]
    assert text[start:end] == (shown or text)
    assert pii.redact(text, added) == text.replace(shown or text, f"<{kind.upper()}>")


@pytest.mark.parametrize("text", ["he arrived at noon dot dot dot", "look at the dot of it", "one two three", "un deux", "see (at) noon", "a at b dot c"])
def test_ordinary_text_stays_clean(text):
    assert pii.find_spans(text) == ([], [])


def test_report(spark):
    texts = [*ODD_TEXTS, "a@b.cc 1.2.3.4 1.2.3.4 +1 (456) 555-2186", "🎉 a@b.cc", "1" * 5_000]
    rows = {r.doc_id: r for r in pii.span_report(clashing(spark, texts)).collect()}
    for i, text in enumerate(texts):
        spans = brute(text) if text and "1" * 5_000 not in text else []
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert rows[i].spans == joined
        assert [rows[i][f"n_{k}"] for k in PATTERNS] == [sum(s[2] == k for s in spans) for k in PATTERNS]


def test_redaction_keeps_columns(spark):
    docs = clashing(spark, ["write a@b.cc now", None, "clean"])
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == ["write <EMAIL> now", None, "clean"]


def test_empty_table(spark):
    assert pii.span_report(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    "text, plain, whole",
    [
        ("to jоhn@example.com now", "hn@example.com", "jоhn@example.com"),
        ("to joe@mail.acmе.com now", "joe@mail.acm", "joe@mail.acmе.com"),
        ("ip 10.0.0.1٢ now", "10.0.0.1", "10.0.0.1٢"),
    ],
)
def test_a_disguised_span_may_contain_a_plain_one(text, plain, whole):
    base, added = pii.find_spans(text)
    assert [text[a:b] for a, b, _ in base] == [plain]
    assert [text[a:b] for a, b, _ in added] == [whole]
    assert pii.redact(text, [*base, *added]) == text.replace(whole, f"<{added[0][2].upper()}>")


@pytest.mark.parametrize(
    "text, shown, kind",
    [
        ("host one nine two dot one six eight dot zero dot one up", "one nine two dot one six eight dot zero dot one", "ip"),
        ("host one nine two.one six eight.zero.one up", "one nine two.one six eight.zero.one", "ip"),
        ("host one nine two [dot] one six eight [dot] zero [dot] one up", "one nine two [dot] one six eight [dot] zero [dot] one", "ip"),
        ("host 192 dot 168 dot 0 dot 1 up", "192 dot 168 dot 0 dot 1", "ip"),
        ("host 10 dot double-two dot 0 dot 1 up", "10 dot double-two dot 0 dot 1", "ip"),
        ("host 192.168.l.1 up", "192.168.l.1", "ip"),
        ("host 192.168.0.l up", "192.168.0.l", "ip"),
        ("call +1 555 one two three 4567 now", "+1 555 one two three 4567", "phone"),
        ("call plus one (five five five) one two three 4567 now", "plus one (five five five) one two three 4567", "phone"),
        ("call +1 2O2 55O 1234 now", "+1 2O2 55O 1234", "phone"),
        ("call +l 2O2 55O l23O now", "+l 2O2 55O l23O", "phone"),
        ("card 4041 eight nine four nine 7460 8795 now", "4041 eight nine four nine 7460 8795", "card"),
        ("write jane at acme dot ai now", "jane at acme dot ai", "email"),
        ("write jane at mail.acme dot technology, now", "jane at mail.acme dot technology", "email"),
    ],
)
def test_partly_disguised_numbers_and_any_last_label(text, shown, kind):
    base, added = pii.find_spans(text)
    assert base == [] and {k for _, _, k in added} == {kind}
    assert shown in {text[a:b] for a, b, _ in added}
    assert pii.redact(text, added) == text.replace(shown, f"<{kind.upper()}>")


@pytest.mark.parametrize("text", ["was at one point in time", "one. two. three. four apples", "5 o 6 o 7", "I am 5. I am 6"])
def test_numbers_in_ordinary_text_stay(text):
    assert pii.find_spans(text) == ([], [])


def test_a_pronoun_after_a_number_stays():
    text = "call +1 555 123 4567. I wait"
    base, added = pii.find_spans(text)
    assert pii.redact(text, [*base, *added]) == "call <PHONE>. I wait"


# One pattern for a whole spoken address; it takes quadratic time on long runs of names.
WHOLE_SPOKEN = re.compile(
    rf"(?<![\w.])[A-Za-z0-9][A-Za-z0-9_%+-]*(?:(?: (?:{pii.DOT_WORDS}) |\.)[A-Za-z0-9_%+-]+)*(?P<at> (?:{pii.AT_WORDS}) )"
    rf"(?!(?:{pii.NO_HOST}) )[A-Za-z0-9-]+(?:(?: (?:{pii.DOT_WORDS}) |\.)[A-Za-z0-9-]+)* (?:{pii.DOT_WORDS}) "
    rf"(?!(?:{pii.NO_END}|{pii.DOT_WORDS})(?!\w))[A-Za-z]{{2,}}(?!\w)",
    re.I,
)


def whole_spoken_edits(text):
    for m in WHOLE_SPOKEN.finditer(text):
        edits = [(*m.span("at"), "@")]
        edits += [(*dot.span(), ".") for part in ((m.start(), m.start("at")), (m.end("at"), m.end())) for dot in pii.SPOKEN_DOT.finditer(text, *part)]
        yield from sorted(edits)


def test_spoken_addresses_equal_one_pattern():
    rng = random.Random(5)
    tokens = [" at ", " At ", " dot ", " punto ", " ", ".", "-", "a", "bob", "dot", "x_y", "com", "the", "é", "%", "+", "at", ",", "of"]
    seen = 0
    for _ in range(60_000):
        some = tokens if rng.random() < 0.5 else [" at ", " dot ", ".", "ab", "x-y", " "]
        text = "".join(rng.choice(some) for _ in range(rng.randint(3, 16)))
        wanted = list(whole_spoken_edits(text))
        assert list(pii.spoken_edits(text)) == wanted, text
        seen += bool(wanted)
    assert seen > 150


@pytest.mark.parametrize("unit", ["a-", "a dot ", "%E3%81", "a at b ", "a at b dot ", "one ", "1 dot ", "a.", "@a", "4 ", "%40", "7", "+1 (", "four-", "О", "l0"])
def test_long_texts_take_linear_time(unit):
    text = unit * (300_000 // len(unit)) + " bob at acme dot com"
    started = time.process_time()
    pii.find_spans(text)
    assert time.process_time() - started < 4
