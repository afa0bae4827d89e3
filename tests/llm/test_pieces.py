import random

import numpy as np
import pytest
import sentencepiece

from pulsegrid.llm.pieces import Model, Transducer, decode, encode
from pulsegrid.llm.pieces_queries import piece_bpe


@pytest.fixture(scope="module")
def coder():
    return Transducer(Model(piece_bpe()))


def odd_texts(count):
    draw = random.Random(2)
    parts = ["a", "B", " ", "  ", "the", "\n", "\t", "'s", "1", "12", "é", " ", "<s>", "你", "!", "!!", "   ", "...", "ñ",
             "▁", "퟿", "x́", "ing", "tion", "<0x0A>", "====", "----"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(12))) for _ in range(count)] + ["", " ", "   ", "a "]


def test_ids_are_the_librarys(coder):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_bpe())
    for text in odd_texts(3000):
        ids = np.frombuffer(coder.encode(text), coder.type).tolist()
        assert ids == library.encode(text), repr(text)
        assert coder.decode(ids) == text.replace("▁", " ")


def test_shortest_path_of_a_unigram_model(coder):
    """Without the restriction to merges the path has the least weight of all segmentations."""
    model = Model(piece_bpe())
    model.bpe = False
    free = Transducer(model)
    for word in ("▁the", "▁stones", "▁hat", "tion"):
        best = {0: (0.0, [])}
        for end in range(1, len(word) + 1):
            options = [(best[s][0] - model.scores[n], best[s][1] + [n]) for s in range(end) if s in best
                       for n in [free.number.get(word[s:end])] if n is not None]
            if options:
                best[end] = min(options)
        path = free._path(word)
        assert sum(-model.scores[n] for n in path) == pytest.approx(best[len(word)][0])


def test_frames(docs, coder):
    rows = [(1, "Hello  world\n"), (1, "Hello  world\n"), (2, None), (3, ""), (None, "ab"), (4, "x" * 100_000), (5, "▁")]
    found = encode(docs(*rows), piece_bpe())
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in found.collect())
    back = sorted(((r.doc_id or 0), r.text) for r in decode(found, piece_bpe()).collect())
    assert back == sorted(((i or 0), (t or "").replace("▁", " ")) for i, t in rows)
    assert encode(docs((1, "a")).limit(0), piece_bpe()).count() == 0


def test_tables_of_a_worker_are_bounded():
    """Words, parts and pairs of pieces are remembered within a bound, and ids do not depend on what is remembered."""
    model, draw = Model(piece_bpe()), random.Random(5)
    small, large = Transducer(model, 100), Transducer(model)
    library = sentencepiece.SentencePieceProcessor(model_file=piece_bpe())
    for _ in range(40):
        small.age()
        assert len(small.follows) <= 200 and len(small.words) + len(small.older) <= 1000
        text = " ".join("".join(draw.choice("abcdeéston,.\n\t你") for _ in range(draw.randrange(1, 45))) for _ in range(60))
        assert small.encode(text) == large.encode(text)
        assert np.frombuffer(small.encode(text), small.type).tolist() == library.encode(text)


def test_a_repeated_word_is_composed_once(monkeypatch):
    """The body of a word is known with and without marks and line ends at its ends."""
    coder, sought = Transducer(Model(piece_bpe())), []
    through = coder._through
    monkeypatch.setattr(coder, "_through", lambda part: sought.append(part) or through(part))
    coder.encode("x Quillfeather Quillfeather, Quillfeather.\nQuillfeather,\nend Quillfeather\n")
    assert sought.count("▁Quillfeather") == 1 and not any("\n" in part and len(part) > 1 for part in sought)
