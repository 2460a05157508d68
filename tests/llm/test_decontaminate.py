import collections
import random

import numpy as np
from pyspark.sql import functions as F
from tables import ODD_TEXTS, clashing, documents, prose

from tidemart.llm import decontaminate as dc


def grams(words, k):
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def brute(text, items):
    found, words = {}, dc.split_words(text)
    for item_id, item in items:
        own = dc.split_words(item)
        if not own:
            continue
        k = min(5, len(own))
        mine, theirs, m = collections.Counter(grams(own, k)), grams(words, k), len(own) - k + 1
        for a in range(len(words) - len(own) + 1):
            both = sum((mine & collections.Counter(theirs[a : a + m])).values())
            if both / (2 * m - both) >= 0.8:
                found[item_id] = max(found.get(item_id, 0), both / (2 * m - both))
    return found


def cases():
    rng = random.Random(5)
    items = [(i, " ".join(prose(100 + i, rng.choice([1, 3, 7, 20, 40, 60])))) for i in range(30)]
    items += [(90, items[3][1]), (91, ""), (92, "!!!")]
    texts = []
    for n in range(60):
        item = rng.choice(items)[1].split()
        if n % 3 == 0 and len(item) > 8:  # some words changed near an end or anywhere
            item[rng.choice([0, -1, rng.randrange(len(item))])] = "changed"
        if n % 5 == 0:
            item = item[1:]
        body = prose(1000 + n, 80)
        at = rng.randrange(len(body))
        texts.append(" ".join(body[:at] + item + body[at:]).upper() if n % 7 == 0 else ", ".join(body[:at] + item + body[at:]))
    return items, texts + [t for t in ODD_TEXTS if t != "a"]


def test_equals_brute_force_over_all_windows():
    items, texts = cases()
    found = dc.ItemIndex(items).search_all(texts)
    wanted = [brute(t, items) if t and len(t) < 10_000 else {} for t in texts]
    assert sum(map(len, wanted)) > 40
    for got, want in zip(found, wanted, strict=True):
        assert {h["item_id"]: round(h["similarity"], 9) for h in got} == {i: round(v, 9) for i, v in want.items()}


def test_blocks_find_everything_within_the_radius():
    rng = np.random.default_rng(1)
    index = dc.ItemIndex([(i, " ".join(prose(i, 20))) for i in range(40)])
    own = index.by_size[20][1]
    flips = [rng.choice(64, int(n), replace=False) for n in rng.integers(0, 30, 500)]
    which = rng.integers(0, 40, 500)
    prints = own[which].copy()
    for i, bits in enumerate(flips):
        prints[i] ^= np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64)) if len(bits) else np.uint64(0)
    got = {(w, i) for ws, js, _ in index.candidates(prints, 20) for w, i in zip(ws.tolist(), js.tolist(), strict=True)}
    distance = np.bitwise_count(prints[:, None] ^ own[None, :])
    assert got == {(w, i) for w, i in np.argwhere(distance <= dc.RADIUS).tolist()}


def test_report_equals_brute_force_in_lots_of_any_size(spark, monkeypatch):
    items, texts = cases()
    benchmark = spark.createDataFrame([*items, items[4], (None, "a b c"), (95, None)], "item_id bigint, text string")
    docs = clashing(spark, texts)
    rows = sorted(dc.leak_report(docs, benchmark).collect())
    assert [(h["item_id"], h["start_word"]) for h in dc.ItemIndex(items).search_all(texts)[0]] == [(r.item_id, r.start_word) for r in rows if r.doc_id == 0]
    wanted = {(d, i): round(v, 9) for d, t in enumerate(texts) if t and len(t) < 10_000 for i, v in brute(t, items).items()}
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in rows} == wanted and len(rows) == len(wanted)
    monkeypatch.setattr(dc, "LOT_BYTES", 7)
    monkeypatch.setattr(dc, "BATCH_CHARS", 300)
    monkeypatch.setattr(dc, "FILTER_BITS", 8)
    assert sorted(dc.leak_report(docs, benchmark).collect()) == rows
    leaking = {r.doc_id for r in rows}
    kept = dc.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - leaking


def test_repeated_rows_and_ids(spark):
    a, b = " ".join(prose(1, 20)), " ".join(prose(2, 12))
    changed = " ".join(["new", *a.split()[1:]])
    benchmark = spark.createDataFrame([(1, a), (1, b), (2, a)], "item_id bigint, text string")
    docs = documents(spark, [a, changed, f"{changed} {b}"])
    rows = [(r.doc_id, r.item_id, r.start_word, r.n_words, round(r.similarity, 6)) for r in dc.leak_report(docs.union(docs), benchmark).collect()]
    near = round(15 / 17, 6)
    one = [(0, 1, 0, 20, 1.0), (0, 2, 0, 20, 1.0), (1, 1, 0, 20, near), (1, 2, 0, 20, near), (2, 1, 20, 12, 1.0), (2, 2, 0, 20, near)]
    assert sorted(rows) == sorted(one * 2)


def test_few_items_meet_a_text_though_all_share_a_sentence(spark):
    common = prose(9, 8, 2000)
    items = [" ".join([*common, *prose(100 + i, 30, 5000)]) for i in range(400)]
    texts = [" ".join([*prose(9000 + i, 20, 5000), *common]) for i in range(100)] + items[:3]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = documents(spark, texts)
    keyed = benchmark.select(dc.text_key(F.col("text")).alias("item"), "text")
    named = docs.select(dc.text_key(F.col("text")).alias("key"), "text")
    pairs = dc.candidates(named, keyed, dc.SIMILARITY).collect()
    assert sorted(r.key for r in pairs) == sorted(r.item for r in pairs) and len(pairs) == 3
    assert sorted((r.doc_id, r.item_id) for r in dc.leak_report(docs, benchmark).collect()) == [(100, 0), (101, 1), (102, 2)]


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert dc.leak_report(documents(spark, ["a b c"]), benchmark).count() == 0
    assert dc.without_leaks(documents(spark, ["a b c"]), benchmark).count() == 1
    assert dc.leak_report(documents(spark, []), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")).count() == 0


def whole(text, item):
    """Similarity of all words of a text with an item."""
    mine, theirs = (collections.Counter(grams(dc.split_words(t), 5)) for t in (item, text))
    return sum((mine & theirs).values()) / max(1, sum((mine | theirs).values()))


def test_documents_shorter_than_the_item_are_compared_whole():
    items = [(i, " ".join(prose(i, n, 2000))) for i, n in enumerate([6, 25, 50, 50, 90])]
    texts = []
    for _, item in items:
        words = item.split()
        for cut in (1, 2, 5, 8, 9, 10, 12, 30):
            texts += [" ".join(words[cut:]), " ".join(words[:-cut]), " ".join(words[: len(words) // 2] + words[len(words) // 2 + cut :])]
    found = dc.ItemIndex(items).search_all(texts)
    wanted = [{i: whole(t, item) for i, item in items if whole(t, item) >= 0.8} for t in texts]
    assert sum(map(len, wanted)) > 20
    for text, got, want in zip(texts, found, wanted, strict=True):
        assert {h["item_id"]: round(h["similarity"], 9) for h in got} == {i: round(v, 9) for i, v in want.items()}
        assert all((h["start_word"], h["n_words"]) == (0, len(text.split())) for h in got)
    # 45 of 50 words in a row.
    near = dc.ItemIndex([items[2]]).search_all([" ".join(items[2][1].split()[:45])])[0]
    assert [round(h["similarity"], 4) for h in near] == [round(41 / 46, 4)]
