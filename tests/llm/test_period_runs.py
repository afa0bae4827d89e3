"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pulsegrid.llm import period_runs
from pulsegrid.llm.period_runs import merged, octaves, open_tiles, runs_and_rest, solve_tile, word_ids, z_function


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def plain_runs(words, least=12):
    """(start, length, period): every stretch of a period that cannot be made longer, if no smaller period has it."""
    out = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= max(least, 2 * q) and smallest_period(words[s:s + length]) == q:
                out.add((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_rest(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return list(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def texts(count=60, seed=3):
    draw = random.Random(seed)
    for i in range(count):
        some = [draw.choice("abcdefghijklmnop"[:draw.randint(1, 16)]) for _ in range(draw.randint(0, 40))]
        out = list(some)
        for _ in range(draw.randint(0, 4)):
            block = [draw.choice("abcxyz") for _ in range(draw.randint(1, 30))]
            repeat = block * draw.randint(1, 9) + block[:draw.randint(0, len(block))]
            out += repeat + [draw.choice("uvw") for _ in range(draw.randint(0, 5))]
        yield i, draw.choice([" ", "\n", " \t "]).join(out)


def found(frame):
    return {r.doc_id: [(x.start, x.length, x.period) for x in r.runs] for r in frame.collect()}


def test_z_function():
    draw = random.Random(1)
    for _ in range(200):
        s = [draw.randint(0, 1) for _ in range(draw.randint(0, 20))]
        z = z_function(s)
        for i in range(1, len(s)):
            k = 0
            while i + k < len(s) and s[i + k] == s[k]:
                k += 1
            assert z[i] == k


def test_tiles_give_each_stretch_of_agreements_in_touching_pieces():
    for _, text in texts(40, seed=9):
        ids = word_ids(text.encode().split())
        n, pieces = len(ids), []
        for low, high, apart, first in open_tiles(ids):
            start = max(first - apart, 0)
            part = ids[start:first + period_runs.TILE * apart + high - 1]
            pieces += solve_tile(part.tolist(), start, low, high, apart, first)
        have = [f for f in merged(pieces) if f[2] - f[1] >= max(f[0], 12 - f[0])]
        want = []
        for q in range(1, n // 2 + 1):
            same = np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(int)
            edges = np.flatnonzero(np.diff(same))
            want += [(q, s, e) for s, e in zip(edges[::2], edges[1::2]) if e - s >= max(q, 12 - q)]
        assert have == sorted(want)


def test_is_repeat():
    draw = random.Random(4)
    for _ in range(500):
        block = [draw.randint(0, 1) for _ in range(draw.randint(1, 6))] * draw.choice([1, 1, 2, 3, 5, 7])
        shorter = any(len(block) % d == 0 and block == block[:d] * (len(block) // d) for d in range(1, len(block)))
        assert period_runs.is_repeat(np.array(block)) == shorter


def test_every_period_is_in_one_octave():
    for n in (0, 1, 16, 1000):
        periods = [q for low, high, _ in octaves(n) for q in range(low, high)]
        assert len(periods) == len(set(periods)) and set(range(1, n // 2 + 1)) <= set(periods)


def test_runs_and_rest(docs):
    rows = list(texts())
    done = runs_and_rest(docs(*rows))
    runs = found(done)
    rest = {r.doc_id: (r.collapsed, r.collapsed_sha256) for r in done.collect()}
    for i, text in rows:
        words = text.split()
        assert runs[i] == plain_runs(words), i
        kept = " ".join(plain_rest(words, runs[i])).encode()
        assert rest[i] == (kept if runs[i] else None, hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("text", [
    None, "", " \n", "a", "a " * 11, "a " * 12, "a b " * 6, "a b c d e f g h " * 2, "a " * 3000,
    ("x " * 40 + "y ") * 40, " ".join(str(i % 700) for i in range(2100)), " ".join(str(i) for i in range(500)) + " 7" * 20])
def test_single_texts(docs, text):
    runs = found(runs_and_rest(docs((1, text))))[1]
    words = (text or "").split()
    if len(words) < 800:
        assert runs == plain_runs(words)
    elif len(set(words)) < 3 and "y" not in words:
        assert runs == [(0, 3000, 1)]
    elif "700" not in words and "699" in words:
        assert runs == [(0, 2100, 700)]
    else:
        assert (0, len(words), 41) in runs and len(runs) == 41


def test_repeated_rows_missing_ids_and_no_rows(docs):
    rows = [(1, "a b " * 9), (1, "a b " * 9), (1, "c " * 30), (None, "a " * 20), (None, "a " * 20), (2, None)]
    out = sorted(((r.doc_id, tuple(tuple(x) for x in r.runs)) for r in runs_and_rest(docs(*rows)).collect()), key=str)
    assert out == sorted([(1, ((0, 2, 18),)), (1, ((0, 2, 18),)), (1, ((0, 1, 30),)), (None, ((0, 1, 20),)),
                          (None, ((0, 1, 20),)), (2, ())], key=str)
    assert runs_and_rest(docs(*rows).limit(0)).count() == 0


def test_query(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.length("text") < 6000)
    texts = {r.doc_id: planted(r.doc_id, (r.text or "").encode().split()) for r in source.collect()}
    rows = {r.doc_id: r for r in entry.queries()["op11_period_runs"](spark, sf_dir).collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seen = 0
    for i, words in texts.items():
        runs, row = plain_runs(words), rows[i]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (1000 * best[1] // best[2] if best else None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(b" ".join(plain_rest(words, runs))).hexdigest()
        seen += len(runs) > 0
    assert seen > 5
