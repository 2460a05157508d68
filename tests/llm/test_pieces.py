import collections
import math

import numpy as np
import pytest
from tables import ODD_TEXTS, clashing, documents

from tidemart.llm import pieces

TEXTS = ["Hello  wörld\nx ▁y", " lead  and trail  ", "日本語 🎉 x", "\n\n", "ab" * 50, "\x00x", " ", "a\tb"]


@pytest.fixture(scope="module")
def vocab():
    return pieces.vocabulary(pieces.MODEL, pieces.SHARPNESS)


def test_decoding_is_lossless(vocab):
    for text, ids in zip(TEXTS, pieces.encode_texts(TEXTS, list(range(len(TEXTS))), vocab, 7), strict=True):
        assert vocab.decode(ids.tolist()) == text


def test_samples_follow_the_weights_of_whole_paths(vocab):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=pieces.MODEL)
    known = {model.id_to_piece(i): i for i in range(3, model.get_piece_size()) if not model.is_byte(i)}
    lattice = "▁the▁one"

    def paths(at):
        if at == len(lattice):
            yield (), 0.0
        for end in range(at + 1, len(lattice) + 1):
            if lattice[at:end] in known:
                i = known[lattice[at:end]]
                for rest, w in paths(end):
                    yield (i, *rest), w + vocab.weight[i]

    every = dict(paths(0))
    total = sum(map(math.exp, every.values()))
    n = 60_000
    seen = collections.Counter(tuple(x.tolist()) for x in pieces.encode_texts(["the one"] * n, list(range(n)), vocab, 7))
    assert set(seen) <= set(every)
    for path, w in every.items():
        p = math.exp(w) / total
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p / n) + 1e-4


def test_a_row_does_not_depend_on_its_batch(vocab):
    alone = pieces.encode_texts([TEXTS[0]], [3], vocab, 7)[0]
    together = pieces.encode_texts(["other words", *TEXTS], [9, 3, *range(20, 27)], vocab, 7)[1]
    assert np.array_equal(alone, together)
    assert not all(np.array_equal(alone, pieces.encode_texts([TEXTS[0]], [k], vocab, 7)[0]) for k in range(4, 30))


def test_report_and_round_trip(spark):
    texts = [*ODD_TEXTS, *TEXTS]
    docs = clashing(spark, texts)
    rows = pieces.decoded(pieces.piece_report(docs), "ids", "again").orderBy("doc_id").collect()
    assert [r.again for r in rows] == texts
    assert all(r.lossless for r in rows if texts[r.doc_id] is not None) and rows[0].ids is None
    assert pieces.piece_report(documents(spark, [])).count() == 0
