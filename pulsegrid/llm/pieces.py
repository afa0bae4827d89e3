"""SentencePiece encoding and decoding as a weighted finite-state transducer.

``Transducer`` compiles a model file: the normaliser (blank to U+2581, a blank put before the text), all pieces
with their scores as arcs of one automaton, and byte fallback for characters without a piece.  A text is
composed with it and the path of least weight (tropical semiring: weights are negated scores, they add along
a path and the least one wins) gives the ids.

For unigram models any sequence of pieces is a path.  For BPE models the least weight alone would not give the
model's segmentation, so the transducer is first restricted to the paths merging can produce: two pieces may
follow each other only if merging their characters leaves exactly these two.  This leaves one path.

The path splits at neighbouring characters that no piece holds side by side, so texts are cut there, each
different part is composed once, and its ids are remembered within a bound.

Rows: NULL and empty texts have no ids; U+2581 in a text reads as a blank; repeated rows get equal ids; an
empty table gives no rows.  ``encode`` keeps doc_id only and adds n_ids, ids and round_trip.
"""

from __future__ import annotations

import heapq
import re
from array import array
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import per_batch

BLANK = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6  # fixed values: kinds of pieces in a model file


def _fields(raw: bytes):
    """(number, value) of every field of a protocol-buffer message; values are int, float bytes or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 4 if kind == 5 else 8
        yield key >> 3, raw[at:at + size]
        at += size


class Model:
    """Pieces, scores and kinds of a model file, and what its normaliser does."""

    def __init__(self, path: str):
        self.pieces, self.scores, self.kinds = [], [], []
        self.bpe, self.byte_fallback, self.prefix, self.squeeze = False, False, True, True
        with open(path, "rb") as file:
            raw = file.read()
        for number, value in _fields(raw):  # fixed values: field numbers of the model format
            if number == 1:
                own = dict(_fields(value))
                self.pieces.append(own[1].decode())
                self.scores.append(float(np.frombuffer(own[2], "<f4")[0]) if 2 in own else 0.0)
                self.kinds.append(own.get(3, _NORMAL))
            elif number == 2:
                own = dict(_fields(value))
                self.bpe, self.byte_fallback = own.get(3, 1) == 2, bool(own.get(35, 0))
            elif number == 3:
                own = dict(_fields(value))
                if own.get(2):
                    raise ValueError("character maps are not supported")
                self.prefix, self.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))


class _Made(dict):
    """Values that are made when their key is first asked for."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class Transducer:
    """most: words (twice over) and, twice as many, pairs of pieces remembered between two batches."""

    def __init__(self, model: Model, most: int = 150_000):
        self.model, self.most = model, most
        self.type = np.dtype("u2" if len(model.pieces) <= 1 << 16 else "u4")
        self.number = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in (_NORMAL, _USER)}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == _BYTE}
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == _UNKNOWN), 0)
        self.inner = {p[i:i + 2] for p in self.number for i in range(len(p) - 1)}
        # the ends of a line and tabs are cut out at once where no piece holds them beside another character
        self.alone = [c for c in "\n\r\t" if not any(c in pair for pair in self.inner)]
        # merging has one outcome, so among pieces of different scores one path at most reaches any place in a text
        # (runs of blanks, which share a score, are merged plainly)
        scores = [model.scores[i] for p, i in self.number.items() if BLANK * 2 not in p]
        self.single = model.bpe and len(set(scores)) == len(scores)
        self.halves: dict[int, tuple[int, int]] = {}
        self.follows = _Made(self._may_follow)  # by both numbers in one
        self.arcs = ahocorasick.Automaton()
        for piece, number in self.number.items():
            if not model.bpe or self._reachable(piece, number):
                self.arcs.add_word(piece, (number, len(piece), -model.scores[number]))
        self.arcs.make_automaton()
        self.words, self.older = _Made(self._again), {}  # ids of words and their parts, newer and older
        self.plain = [self._plain(i) for i in range(len(model.pieces))]

    # --- which pieces may follow each other in a BPE model ---

    def _merge(self, text: str, stop_at: int | None = None) -> list[int] | tuple[int, int]:
        """Pieces of a text by merging the best-scored neighbours, leftmost first; or the two halves of its last merge."""
        parts = [self.number.get(c, -1) for c in text]
        names, nexts, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            right = nexts[left]
            if right < len(names) and (number := self.number.get(names[left] + names[right])) is not None:
                heapq.heappush(queue, (-self.model.scores[number], left, names[left] + names[right]))

        for i in range(len(names) - 1):
            offer(i)
        while queue:
            _, left, name = heapq.heappop(queue)
            right = nexts[left] if names[left] else len(names)
            if not names[left] or right >= len(names) or names[left] + names[right] != name:
                continue
            if stop_at is not None and self.number[name] == stop_at and len(name) == len(text):
                return self.number[names[left]], self.number[names[right]]
            names[left], names[right], parts[left] = name, "", self.number[name]
            nexts[left] = nexts[right]
            if nexts[left] < len(names):
                before[nexts[left]] = left
                offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [p for p, n in zip(parts, names) if n]

    def _reachable(self, piece: str, number: int) -> bool:
        if len(piece) == 1:
            return True
        halves = self._merge(piece, number)
        if isinstance(halves, tuple):
            self.halves[number] = halves
            return True
        return False

    def _may_follow(self, both: int) -> bool:
        """Whether merging the characters of both pieces leaves both: undo their merges, the latest first, and
        see if anything across the border would have been merged before."""
        left, right = both >> 32, both & 0xFFFFFFFF
        scores, pieces, l, r = self.model.scores, self.model.pieces, left, right
        # merges across the border happen at their score, or in case of a tie if they lie further left
        last, tie = -float("inf"), True
        while True:
            across = self.number.get(pieces[l] + pieces[r])
            if across is not None and (scores[across] > last or (scores[across] == last and tie)):
                return False
            l_made, r_made = l in self.halves, r in self.halves
            if not l_made and not r_made:
                return True
            # merges inside the left piece lie left of the border and win ties
            if l_made and (not r_made or scores[l] < scores[r]):
                last, tie = scores[l], False
                l = self.halves[l][1]
            else:
                last, tie = scores[r], True
                r = self.halves[r][0]

    # --- composition and shortest path ---

    def _path(self, part: str) -> list[int]:
        """Ids of the path of least weight through a part."""
        ids = self._through(part)
        if ids is None:  # no piece for some character
            return [i for c in part for i in (self._path(c) if c in self.number else self._spelt(c))]
        return ids

    def _through(self, part: str) -> list[int] | None:
        begin, last = self._only(part) if self.single else self._least(part)
        ids, at = [], len(part) - 1
        if part and last[at] < 0:
            return None
        while at >= 0:
            ids.append(last[at])
            at = begin[at]
        return ids[::-1]

    def _only(self, part: str) -> tuple[list[int], list[int]]:
        """For every character, the piece that ends there on the only path from the start (-1 without a path), and where the
        piece before it ends."""
        follows = self.follows
        begin, last = [-1] * len(part), [-1] * len(part)
        for end, (number, size, _) in self.arcs.iter(part):
            if last[end] < 0:
                start = end - size
                if start < 0 or ((left := last[start]) >= 0 and follows[left << 32 | number]):
                    begin[end], last[end] = start, number
        return begin, last

    def _least(self, part: str) -> tuple[list[int], list[int]]:
        """The same on the path of least weight, of several that may meet."""
        begin, last = [-1] * len(part), [-1] * len(part)
        weight = [0.0] * len(part)
        bpe = self.model.bpe
        for end, (number, size, cost) in self.arcs.iter(part):
            start = end - size
            if start >= 0:
                if last[start] < 0 or (bpe and not self.follows[last[start] << 32 | number]):
                    continue
                cost += weight[start]
            if last[end] < 0 or cost < weight[end]:
                begin[end], last[end], weight[end] = start, number, cost
        return begin, last

    def _spelt(self, character: str) -> list[int]:
        if not self.model.byte_fallback:
            return [self.unknown]
        return [self.bytes[b] for b in character.encode()]

    def _word(self, word: str) -> bytes:
        """Ids of a word: cut where no piece reaches across, each part by its path (or, where blanks of equal
        score meet, by merging)."""
        if self.model.bpe and BLANK * 2 in word:
            return self._raw([i for run in re.findall(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+", word) for i in self._merged(run)])
        inner, out, start = self.inner, [], 0
        if self.single and len(word) <= _SHORT:  # a path leads through the cuts too; only the last is made, for what stands before it
            if len(word) > 1 and word[-2:] not in inner:
                return self.words[word[:-1]] + self.words[word[-1]]
            if (ids := self._through(word)) is not None:
                return self._raw(ids)
        cuts = [i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in inner]
        if not cuts:
            return self._raw(self._path(word))
        for i in [*cuts, len(word)]:
            out.append(self.words[word[start:i]])
            start = i
        return b"".join(out)

    def _again(self, word: str) -> bytes:
        return self.older.get(word) or self._word(word)

    def _merged(self, run: str) -> list[int]:
        return [i for c, i0 in zip(self._names(run), self._merge(run)) for i in ([i0] if i0 >= 0 else self._spelt(c))]

    def _names(self, run: str) -> list[str]:
        """Texts of the pieces ``_merge`` gives, in order."""
        names, at = [], 0
        for number in self._merge(run):
            size = 1 if number < 0 else len(self.model.pieces[number])
            names.append(run[at:at + size])
            at += size
        return names

    def _raw(self, ids: list[int]) -> bytes:
        return array(self.type.char, ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as numbers of the transducer's type."""
        if not text:
            return b""
        if BLANK in text:
            text = text.replace(BLANK, " ")
        if self.model.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if "  " in text or text[:1] == " ":  # blanks side by side belong to the word behind them
            words = text.split(" ")
            head = self._word(words[0]) if words[0] and not self.model.prefix else b""
            joined = BLANK + BLANK.join(words if self.model.prefix else words[1:])
            return head + b"".join([self._word(run) for run in re.findall(f"{BLANK}+[^{BLANK}]*", joined)])
        text = text.replace(" ", " " + BLANK)
        for c in self.alone:
            if c in text:
                text = text.replace(c, f" {c} ")
        return b"".join(map(self.words.__getitem__, ((BLANK if self.model.prefix else "") + text).split(" ")))

    def age(self) -> None:
        """Forget what was not used lately; between batches."""
        if len(self.words) > self.most:
            self.words, self.older = _Made(self._again), self.words
        if len(self.follows) > 2 * self.most:
            self.follows.clear()

    def _plain(self, number: int) -> bytes:
        kind, piece = self.model.kinds[number], self.model.pieces[number]
        if kind == _BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind == _CONTROL else b" \xe2\x81\x87 " if kind == _UNKNOWN else piece.replace(BLANK, " ").encode()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text[:1] == " " else text


_SHORT = 32  # characters of a word that is not cut up before its path is sought
_ROWS = 500  # texts a worker holds decoded, with their ids, at a time
_TRANSDUCERS: dict[str, Transducer] = {}  # one per worker process and model


def transducer(path: str) -> Transducer:
    if path not in _TRANSDUCERS:
        _TRANSDUCERS[path] = Transducer(Model(path))
    return _TRANSDUCERS[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_ids, ids and round_trip (decoding gives the text back, U+2581 read as a blank) of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = transducer(model)
        coder.age()
        texts = batch["text"].to_pylist()
        numbers = [np.frombuffer(coder.encode(t), coder.type) for t in texts]
        same = [coder.decode(n.tolist()) == t.replace(BLANK, " ") for n, t in zip(numbers, texts)]
        sizes = np.array([len(n) for n in numbers], np.int64)
        ids = pa.ListArray.from_arrays(pa.array(np.append(0, sizes.cumsum()).astype(np.int32)),
                                       pa.array(np.concatenate(numbers).astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes), ids, pa.array(same)],
                                          names=["doc_id", "n_ids", "ids", "round_trip"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(per_batch(work, _ROWS), "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = transducer(model)
        texts = [coder.decode(ids or []) for ids in batch["ids"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(per_batch(work), "doc_id long, text string")
