import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from pulsegrid.llm import token_files
from pulsegrid.llm.token_files import Shard, WordEncoder, _keys, corpus_positions, make_shard, read_token_files, write_token_files
from pulsegrid.llm.token_files_queries import byte_bpe


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(byte_bpe())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_librarys(library):
    draw = random.Random(3)
    parts = ["word,", "Ab.", "x;", "é!", "ß:", "a", "B", " ", "  ", "\n", "\t", "'s", "1", "é", " ", "\x1c", "<|endoftext|>", "你", "!", "   ", "\r", "Ġ", "x́", " the"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(30))) for _ in range(4000)] + ["", " ", "  ", "a ", "\n\n a"]
    encoder = WordEncoder(byte_bpe(), most=500)  # forgets often
    for at in range(0, len(texts), 200):
        for text, raw in zip(texts[at:at + 200], encoder.encode(texts[at:at + 200])):
            assert np.frombuffer(raw, "<u2").tolist() == library(text), repr(text)


def test_ids_where_lines_and_marks_are_cut(library, monkeypatch):
    draw = random.Random(6)
    parts = ["word,", "x", "Ab.", "é!", "ж;", ".", ",", "\n", "\n\n", "\nNext", "\nNext,", "\nA's", " \n", " ", "  ", ", ", ". ", "\r\n", "\x01", " \x01, ", "\x01,", "\xa0", "\x85", "\u2028", " a", "<|endoftext|>"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(12))) for _ in range(4000)] + ["\n", "\na", "a\n", " \n a", "\x01"]
    encoder, met = WordEncoder(byte_bpe(), most=500), []
    ids = [raw for at in range(0, len(texts), 200) for raw in encoder.encode(texts[at:at + 200])]
    assert [np.frombuffer(raw, "<u2").tolist() for raw in ids] == [library(text) for text in texts]
    assert encoder.encode([]) == [] and encoder.encode(["", ""]) == [b"", b""]
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda pieces, into: (met.extend(pieces), learn(pieces, into)))
    encoder.encode([f"one two{i}.\nThree four, five".replace(str(i), chr(97 + i)) for i in range(9)])
    assert met == ["one"]  # "twoa.\nThree" was a piece cut by a pattern, before


def expected(rows, library):
    start, out = 0, []
    for i, text in sorted(((i, t or "") for i, t in rows if i is not None)):
        ids = [*library(text), 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out)


def test_positions_read_back(spark, docs, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 2)
    rows = [(i * 37 - 400, f"text {i} " * (i % 9)) for i in range(60)]
    rows += [(5, None), (6, ""), (7, "long " * 30_000), (8, "twice"), (8, "twice"), (8, "other"), (None, "lost")]
    path = str(tmp_path / "tokens")
    write_token_files(docs(*rows), path, byte_bpe(), width=64)
    found = corpus_positions(read_token_files(spark, path))
    assert sorted(map(tuple, found.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected(rows, library)


def test_ranges_of_many_bytes_are_cut_into_parts(spark, docs, library, tmp_path):
    rows = [(i, f"text {i} " * (20 if i % 7 else 400)) for i in range(90)] + [(3, "again"), (3, "again")]
    path = str(tmp_path / "tokens")
    write_token_files(docs(*rows), path, byte_bpe(), width=64, most_bytes=4000)
    shards = read_token_files(spark, path)
    assert shards.count() > 10 and shards.where("part > 3").count()
    found = corpus_positions(shards)
    assert sorted(map(tuple, found.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected(rows, library)


def test_no_documents(spark, docs, tmp_path):
    write_token_files(docs((1, "a")).limit(0), str(tmp_path / "none"), byte_bpe())
    assert corpus_positions(read_token_files(spark, str(tmp_path / "none"))).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 64, 513, 3000])
def test_keyed_access(n):
    draw = np.random.default_rng(n)
    ids = np.sort(draw.choice(10**12, n, replace=False))
    encoded = [np.arange(k % 7, dtype="<u2").tobytes() for k in range(n)]
    row = make_shard(0, ids, encoded, np.dtype("<u2"), 2)
    shard = Shard(row)
    assert len(shard.slots) == n  # minimal: a slot for each key and no other
    for k in draw.integers(0, n, 50).tolist():
        assert shard.ids_of(int(ids[k])).tolist() == [*range(k % 7), 2]
    foreign = np.setdiff1d(draw.choice(10**12, 2000), ids)
    assert (shard.where(_keys(np.sort(foreign)))[0] >= 0).mean() < 0.01
