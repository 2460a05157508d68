import collections
import math
import re
import zlib

import numpy as np
import pytest
from tables import ODD_TEXTS, clashing, documents, prose

from tidemart.llm import lm
from tidemart.llm.trie import EliasFano, Level, Sequence, Trie


def tokens(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


def brute(texts, order):
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    count, after = collections.Counter(), collections.defaultdict(collections.Counter)
    for text, h in zip(texts, held, strict=True):
        words = tokens(text)
        if not h:
            count.update(words)
            for k in range(1, order):
                for i in range(k, len(words)):
                    after[tuple(words[i - k : i])][words[i]] += 1
    n, v = sum(count.values()), len(count)

    def chance(context, word):
        if not context:
            return (count[word] + 1) / (n + v + 1)
        seen, lower = after.get(context), chance(context[1:], word)
        if not seen:
            return lower
        return (seen[word] + len(seen) * lower) / (sum(seen.values()) + len(seen))

    out = []
    for text, h in zip(texts, held, strict=True):
        words = tokens(text)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words)
        score = sum(math.log10(chance(tuple(words[max(0, i - order + 1) : i]), w)) for i, w in enumerate(words))
        out.append((h, len(words), sum(count[w] > 0 for w in words), n, base, score))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_brute_force(spark, order):
    texts = [" ".join(prose(i // 2, 60, 90)) + (" The END" if i % 3 else "") for i in range(40)] + ODD_TEXTS
    found, _ = lm.scores(clashing(spark, texts), order)
    rows = {r.doc_id: r for r in found.collect()}
    for i, (held, n, known, total, base, score) in enumerate(brute(texts, order)):
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        # One byte for a probability is right within four per cent.
        assert abs(r.score - score) < 0.02 * n


def test_elias_fano_finds_exactly_what_is_there():
    rng = np.random.default_rng(0)
    for universe, n in ((1 << 61, 1), (1 << 61, 5_000), (1 << 50, 40_000), (100, 60), (10, 0), (1, 1)):
        values = np.unique(rng.integers(0, universe, n))
        # A gap in the upper part, and runs of equal upper bits.
        values = np.unique(np.concatenate([values, values // 1_000 + (universe >> 1)])) if n > 1 else values
        sequence = Sequence(EliasFano.of(values))
        n = len(values)
        assert np.array_equal(sequence.at(np.arange(n)), values)
        none, all_of = np.zeros(n, np.int64), np.full(n, n)
        assert np.array_equal(sequence.find(values, none, all_of), np.arange(n))
        other = np.setdiff1d(np.concatenate([values ^ 1, values + universe, rng.integers(0, universe, 100)]), values)
        assert (sequence.find(other, np.zeros(len(other), np.int64), np.full(len(other), n)) == -1).all()
        # Out of its range a value is not found.
        assert (sequence.find(values, none, np.arange(n)) == -1).all()
        assert (sequence.find(values, np.arange(1, n + 1), all_of) == -1).all()


def test_repeated_values_of_pointers():
    values = np.sort(np.random.default_rng(3).integers(0, 300, 900))
    assert np.array_equal(Sequence(EliasFano.of(values)).at(np.arange(900)), values)


def small_trie(contexts=2_000, entries=50_000, words=1 << 20):
    rng = np.random.default_rng(1)
    heads = np.unique(rng.integers(0, words, contexts))
    pairs = np.unique(np.stack([rng.integers(0, len(heads) // 2, entries), rng.integers(0, words, entries)], axis=1), axis=0)
    begins = np.searchsorted(pairs[:, 0], np.arange(len(heads) + 1))
    top = Level(heads, np.array([0, len(heads)]), np.zeros(len(heads)), np.full(len(heads), 0.1))
    return heads, pairs, Trie.blob([top, Level(pairs[:, 1], begins, np.full(len(pairs), 0.01), np.ones(len(pairs)))])


def test_a_trie_is_small_and_found_in_by_context():
    heads, pairs, blob = small_trie()
    # Two bytes and a half for a word of a context, one each for probability and weight.
    assert len(blob) < 5 * len(pairs) + 8 * len(heads)
    trie = Trie(blob)
    zero = np.zeros(1, np.int64)
    assert np.array_equal(trie.find(0, zero, np.zeros(len(heads), np.int64), heads), np.arange(len(heads)))
    place = trie.find(1, np.arange(len(heads)), pairs[:, 0], pairs[:, 1])
    assert np.array_equal(place, np.arange(len(pairs))) and set(trie.chance(1, place)) == {57}
    # The same words after another context, an empty one, or an unknown one.
    known = set(map(tuple, pairs.tolist()))
    shifted = (pairs[:, 0] + 1) % (len(heads) // 2)
    other = trie.find(1, np.arange(len(heads)), shifted, pairs[:, 1])
    assert np.array_equal(other >= 0, [(c, w) in known for c, w in zip(shifted.tolist(), pairs[:, 1].tolist(), strict=True)])
    empty = np.full(len(pairs), len(heads) - 1)
    assert (trie.find(1, np.arange(len(heads)), empty, pairs[:, 1]) == -1).all()
    assert (trie.find(1, np.full(len(heads), -1), pairs[:, 0], pairs[:, 1]) == -1).all()


def test_look_ups_read_the_code_in_place():
    _, pairs, blob = small_trie()
    words, begins, _, _ = Trie(blob).levels[1]
    assert isinstance(words.lows.base, np.memmap) and isinstance(words.words.base, np.memmap)
    assert words.ones.nbytes + words.zeros.nbytes < len(pairs)


def test_places_beyond_24_bits():
    """More contexts than 2 ** 24, and a level whose values need more than 40 bits."""
    n = (1 << 24) + 1_000
    words = np.full(n, (1 << 20) - 1, np.int64)
    words[::2] = 7
    level = Level(words, np.arange(n + 1), np.ones(n), np.ones(n))
    values = level.values()
    assert values[-1] > 1 << 40
    sequence, begins = Sequence(EliasFano.of(values)), np.arange(n + 1)
    ask = np.array([0, 1, (1 << 24) - 1, 1 << 24, (1 << 24) + 1, n - 1])
    base = np.where(ask > 0, sequence.at(np.maximum(ask - 1, 0)), 0)
    assert np.array_equal(sequence.find(words[ask] + base, begins[ask], begins[ask + 1]), ask)
    assert (sequence.find(words[ask] + base + 1, begins[ask], begins[ask + 1]) == -1).all()


def test_distinct_pairs_however_large():
    rng = np.random.default_rng(2)
    for words in (rng.integers(0, 50, 1_000), rng.integers(0, 1 << 61, 1_000) // 3 * 3):
        context = rng.integers(0, 40, 1_000)
        parents, found, place = lm.distinct(context, words)
        assert np.array_equal(parents[place], context) and np.array_equal(found[place], words)
        assert list(zip(parents, found, strict=True)) == sorted(set(zip(context.tolist(), words.tolist(), strict=True)))


@pytest.mark.parametrize("order", [2, 3])
def test_a_first_word_in_most_bigrams_is_split(spark, order, monkeypatch):
    """One word begins every other bigram; its n-grams are dealt over the shards and scores stay right."""
    monkeypatch.setattr("tidemart.llm.chunks.CHUNK_BYTES", 3_000)
    texts = [" ".join(f"hot {w}" for w in prose(i // 3, 60, 300)) for i in range(50)]
    docs = documents(spark, texts)
    seen = {}
    real = lm.Numbering.of.__func__

    def spy(cls, *args):
        seen["numbering"] = real(cls, *args)
        return seen["numbering"]

    monkeypatch.setattr(lm.Numbering, "of", classmethod(spy))
    found, (tries, after) = lm.scores(docs, order, shards=16)
    rows = {r.doc_id: r for r in found.collect()}
    for i, (held, n, known, total, base, score) in enumerate(brute(texts, order)):
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        assert abs(r.score - score) < 0.02 * n
    numbering = seen["numbering"]
    assert len(numbering.split) >= 1 and numbering.parts.max() >= 10 and len(numbering.split) <= 32
    assert tries.count() >= 10 and after.count() == len(numbering.split)


def test_rows_without_id_repeats_and_empty_tables(spark):
    schema = "doc_id bigint, text string"
    rows = lm.score_report(spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], schema)).collect()
    assert len(rows) == 4 and len({r.score for r in rows if r.n_tokens == 3}) == 1
    assert lm.score_report(documents(spark, [])).count() == 0


def test_the_query_scores_by_two_words_of_context(spark):
    texts = [" ".join(prose(i // 2, 60, 30)) for i in range(30)]
    rows = {r.doc_id: r.score for r in lm.score_report(documents(spark, texts)).collect()}
    two, three = ([b[-1] for b in brute(texts, order)] for order in (2, 3))
    assert sum(abs(rows[i] - s) for i, s in enumerate(three)) < 0.1 * sum(abs(a - b) for a, b in zip(two, three, strict=True))
