import random
import unicodedata
import zlib

import numpy as np
from tables import ODD_TEXTS, clashing, documents

from tidemart.llm import string_kernel as sk

SYLLABLES = {"en": ["th", "ing", "er", "on", "wh"], "fr": ["eau", "é", "que", "oi", "ç"], "ру": ["ов", "ст", "ка", "й"], "ja": ["日", "本", "語", "の"]}


def grams(text):
    """The set of n-grams up to four, spelled out."""
    folded = "".join(c.lower() if unicodedata.category(c)[0] in "LM" else " " for c in text)
    folded = " " + " ".join(folded.split(" ")) + " "
    folded = " ".join(folded.split(" "))
    while "  " in folded:
        folded = folded.replace("  ", " ")
    return {folded[i : i + n] for n in range(1, 5) for i in range(len(folded) - n + 1)}


def written(lang, seed, n=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_sets_and_kernel_equal_brute_force():
    texts = [written(lang, i, n) for i, (lang, n) in enumerate([("en", 30), ("fr", 5), ("ру", 60), ("ja", 1), ("en", 900)])]
    texts += ["a", "Dé-jà, vu!  42", "x" * 30, "क्षेत्र में"]
    presence = sk.Presence()
    found, wanted = [presence.of(t) for t in texts], [grams(t) for t in texts]
    # Different grams may share one of the places, rarely.
    for f, w in zip(found, wanted, strict=True):
        assert len(w) - 3 <= len(f) <= len(w)
    kernel = sk.Model([], found[:4]).kernel(found)
    exact = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in wanted[:4]] for a in wanted])
    assert np.abs(kernel - exact).max() < 0.01


def test_a_text_cut_into_slices_has_the_same_set(monkeypatch):
    text = written("fr", 1, 300)
    whole = sk.Presence().of(text)
    monkeypatch.setattr(sk, "SLICE", 50)
    assert np.array_equal(sk.Presence().of(text), whole)


def test_ridge_equals_the_plain_solution():
    """With all texts as landmarks Nyström is exact: K (K + r)^(-1) y."""
    texts = [written(lang, 10 * i + j, 20) for i, lang in enumerate(SYLLABLES) for j in range(6)]
    y = np.repeat(np.eye(4), 6, axis=0)
    presence = sk.Presence()
    model = sk.Model(list(SYLLABLES), [presence.of(t) for t in texts])
    k = model.kernel(model.sets)
    model.solve(k.T @ k, k.T @ y, ridge=0.3)
    plain = k @ np.linalg.solve(k + 0.3 * np.eye(len(k)), y)
    assert np.abs(model.kernel(model.sets) @ model.coefficients - plain).max() < 1e-3


def corpus(spark):
    rows = []
    for i in range(240):
        lang = list(SYLLABLES)[i % 4] if i % 40 else "en"
        rows.append((i, written(lang, i, 3 + i % 50), lang if i % 11 else None))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), {r[0]: r for r in rows}


def test_held_out_languages_are_told(spark):
    docs, rows = corpus(spark)
    found = sk.language_report(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    right = [r.lang_pred == rows[r.doc_id][2] for r in found if r.held_out and rows[r.doc_id][2]]
    assert len(right) > 20 and sum(right) >= 0.97 * len(right)


def test_predictions_use_the_text_alone_and_learn_from_training_rows_only(spark):
    docs, rows = corpus(spark)
    wanted = {r.doc_id: (r.lang_pred, r.score) for r in sk.language_report(docs).collect()}
    other = docs.selectExpr("doc_id", "text", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0, 'zz', lang) as lang")
    assert {r.doc_id: (r.lang_pred, r.score) for r in sk.language_report(other).collect()} == wanted
    model = sk.fit(docs)
    moved = docs.selectExpr("doc_id + 1000 as doc_id", "text")
    again = {r.doc_id - 1000: (r.lang_pred, r.score) for r in sk.predicted(moved, model).collect()}
    assert again == wanted


def test_bounds_of_the_fit(spark):
    docs, _ = corpus(spark)
    model = sk.fit(docs, fit_rows=40, landmarks=8, most_languages=3)
    assert len(model.languages) == 3 and "en" in model.languages and len(model.sets) == 6


def test_odd_texts_repeats_and_clashing_columns(spark):
    found = {r.doc_id: r for r in sk.language_report(clashing(spark, [*ODD_TEXTS, "12 34", "!"])).collect()}
    for i in (0, 1, 2, len(ODD_TEXTS), len(ODD_TEXTS) + 1):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert all(found[i].lang_pred == "en" for i in range(3, len(ODD_TEXTS)))
    same = spark.createDataFrame([(None, "a b", "en"), (1, "a b", "en"), (1, "a b", "en")], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in sk.language_report(same).collect()] == ["en"] * 3


def test_without_languages_or_rows(spark):
    none = documents(spark, ["some text", None]).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in sk.language_report(none).collect()} == {("und", 0.0)}
    assert sk.language_report(documents(spark, [])).count() == 0
