import hashlib
import json
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from tables import ODD_TEXTS, clashing, documents, prose

from tidemart.llm import token_alignment as ta

CODERS = ta.encoders(ta.BYTE_MODEL, ta.PIECE_MODEL)


def tokens(text):
    """(id, bytes) lists of both tokenizers by their own libraries, or none."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    byte, piece = Tokenizer.from_file(ta.BYTE_MODEL), SentencePieceProcessor(model_file=ta.PIECE_MODEL)
    byte.encode_special_tokens = True
    if not text:
        return [], []
    alphabet = ta.byte_alphabet()
    names = {i: n for n, i in json.load(open(ta.BYTE_MODEL))["model"]["vocab"].items()}
    a = [(i, bytes(alphabet[c] for c in names[i])) for i in byte.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in piece.encode(text):
        name = piece.id_to_piece(i)
        b.append((i, bytes([int(name[3:5], 16)]) if piece.is_byte(i) else name.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def brute(texts):
    """Byte by byte, pair by pair."""
    found, corpus = [], Counter()
    for text in texts:
        a, b = tokens(text)
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, data in side:
                out.append((i, at, at + len(data)))
                at += len(data)
            spans.append(out)
        ends = {e for _, _, e in spans[0]} & {e for _, _, e in spans[1]}
        groups, start = [], 0
        for end in sorted(ends):
            groups.append([[i for i, s, e in side if start <= s and e <= end] for side in spans])
            start = end
        links = [(i, j) for i, s, e in spans[0] for j, u, v in spans[1] if s < v and u < e]
        corpus.update(links)
        found.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, j), n in corpus.items():
        best[j] = max(best[j], n)
    out = []
    for n_a, n_b, groups, links in found:
        written = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if n_a else ""
        out.append((n_a, n_b, len(groups), len(links), sum(corpus[x] == best[x[1]] for x in links), sum(corpus[x] for x in links), digest))
    return out


TEXTS = [
    "Hello world, it's 2024!  Two  spaces\n\nand lines", "naïve café déjà vu", "日本語のテキスト です", "emoji 👍🏽 ok", "<|endoftext|> and <s> </s> <unk>",
    "a ▁ literal mark", " leading", "trailing ", "   ", "x", "\u0000 nul", "ಕನ್ನಡ हिन्दी", "don't we'll 's 're", "same words same words", " nbsp 　wide",
]


def rows(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


@pytest.mark.parametrize("long", [10, 1 << 20])
def test_alignment_equals_brute_force(spark, long):
    texts = [*TEXTS, *[" ".join(prose(i, 20 + 9 * i, 60)) + (", 12-34 (x)" * i) for i in range(12)], *[t and t[:300] for t in ODD_TEXTS]]
    found, _ = ta.alignments(clashing(spark, texts), long=long, size=7)
    assert rows(found) == dict(enumerate(brute(texts)))


def fragments(text, size):
    text = " " + text
    a, b = (ta.cuts(text, at, size) for at in (ta.CUT_A, ta.CUT_B))
    start = lambda c, i: len(text[: c[i]].encode())
    return [ta.Fragment.of(text[a[i] : a[i + 1]], start(a, i), text[b[i] : b[i + 1]], start(b, i), *CODERS) for i in range(len(a) - 1)]


def same(x, y):
    return x.whole == y.whole and all(np.array_equal(getattr(x, n), getattr(y, n)) for n in ta.FRAGMENT_NAMES[:5])


def test_fragments_are_a_monoid_and_any_tree_gives_the_whole_text():
    rng = random.Random(3)
    opened = 0
    for seed in range(12):
        text = " ".join(prose(seed, 80)) + "".join(rng.choice(["  x", " -", "-\n a", "... ", " é", " 4 5", "日本 "]) for _ in range(60))
        parts = fragments(text, rng.randint(5, 40))
        opened += sum(not np.array_equal(p.a_ends[-1:], p.b_ends[-1:]) for p in parts)
        whole = ta.Fragment.of(" " + text, 0, " " + text, 0, *CODERS)
        assert same(ta.reduced(parts), whole)
        left = parts[0]
        for p in parts[1:]:
            left = left.compose(p)
        right = parts[-1]
        for p in parts[-2::-1]:
            right = p.compose(right)
        assert same(left, whole) and same(right, whole)
        x, y, z = (parts[i] for i in (0, 1, 2))
        assert same(x.compose(y).compose(z), x.compose(y.compose(z)))
        none = ta.Fragment.nothing()
        assert same(none.compose(x), x) and same(x.compose(none), x)
        assert same(ta.Fragment.read(list(x.row())), x)
    assert opened > 10


def test_fast_ids_are_those_of_the_file(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + TEXTS + [" " * 5_000, "ab" * 5_000, "'" * 999]
    assert CODERS[0].ranked is not None
    for text in texts:
        assert CODERS[0].encode(" " + text).tolist() == CODERS[0].library.encode(" " + text, add_special_tokens=False).ids


def test_long_texts_without_a_place_to_cut(spark):
    texts = ["x" * 3_000, "word " * 2_000, " " * 700, None]
    found, _ = ta.alignments(documents(spark, texts), long=100, size=50)
    short, _ = ta.alignments(documents(spark, texts))
    assert rows(found) == rows(short)


def test_repeats_null_ids_and_empty_tables(spark):
    found, pairs = ta.alignments(spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id bigint, text string"))
    found = found.collect()
    assert len(found) == 3 and len({r.count_sum for r in found}) == 1 and found[0].count_sum == 3 * found[0].n_links
    assert {r.links for r in pairs.collect()} == {3}
    assert ta.alignment_report(documents(spark, [])).count() == 0


def test_library_is_loaded_for_unsettled_texts_only():
    byte = ta.ByteEncoder(ta.BYTE_MODEL)
    byte.encode(" plain text")
    assert "library" not in vars(byte)
    assert byte.encode(" ಕನ್ನಡ").tolist() == byte.library.encode(" ಕನ್ನಡ", add_special_tokens=False).ids


def test_chunk_holds_its_tokens_once():
    texts = [" " + " ".join(prose(i, 500)) for i in range(200)]
    chunk = ta.Chunk(*CODERS)
    for i, text in enumerate(texts):
        chunk.add(i, ta.Fragment.of(text, 0, text, 0, *CODERS))
    links = sum(len(f.a) + len(f.b) - len(f.marks) for f in chunk.fragments)
    tracemalloc.start()
    chunk.row(1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * links


def test_chunks_meet_their_answers_one_at_a_time(spark):
    found, _ = ta.alignments(documents(spark, ["one text", "and another", None]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan


@pytest.mark.parametrize("long", [10, 1 << 20])
def test_chunks_of_several_arrow_batches_keep_their_own_answers(spark, long):
    texts = ["a", " ".join(prose(1, 200)), "b c", " ".join(prose(2, 90)), None, "a"]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        found, _ = ta.alignments(documents(spark, texts).coalesce(1), long=long, size=50)
        assert rows(found) == dict(enumerate(brute(texts)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
