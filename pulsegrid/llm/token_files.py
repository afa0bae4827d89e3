"""Token-id shards with a minimal perfect hash index.

A shard holds the documents of one range of ids (``width`` consecutive doc_ids) in ascending order; a range
whose texts have more than ``most_bytes`` is cut into parts of about that size, so what a task holds is bounded
by that and its longest document (all rows of one id count as one).  One row of the table is one shard file:

* ``payload``: the raw little-endian ids of all documents, each closed by ``end_id``; 16 bits an id while
  the vocabulary allows, else 32 (``id_bytes``);
* ``seeds``: one displacement per bucket of keys (hash and displace), which sends the n keys of the shard
  to the slots 0 to n-1 without a gap or a collision;
* ``doc_ids``: the ids in order, for whole scans;
* ``slots``: per slot the start in the payload, the number of ids and a 32-bit fingerprint of the key.

A look-up hashes the key to its bucket, applies the bucket's seed, compares the fingerprint and reads
``payload[start:start + count]``: constant time.  A foreign key passes with probability 2**-32.

Shards are written and read by Spark, so they live wherever the cluster keeps its tables and a lost
executor's shards are made again.  Names of added tokens in a text are read as those tokens.  NULL or empty texts hold the end id alone; rows that repeat a doc_id lie
beside each other, ordered by text, the key finds the
first and scans find all; rows without a doc_id are left out;
an empty table gives no shard.  Extra columns are ignored.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import Stored, per_batch

WIDTH = 512  # consecutive doc_ids of a shard
MOST_BYTES = 32 << 20  # of the texts of a shard
BROADCAST_PARTS = 1_000_000  # documents of cut ranges that are sent to all tasks; more are joined by exchange
BLOCK = 4096  # shards whose sizes are summed in one task
SHARD = ("shard long, part int, n_docs long, n_tokens long, id_bytes int, end_id long, "
         "doc_ids binary, seeds binary, slots binary, payload binary")
_SLOT = np.dtype([("start", "<u4"), ("count", "<u4"), ("print", "<u4")])
_PER_BUCKET = 4
_MARKS = frozenset(",.;:!?")  # each a pre-token of its own after letters and before a blank


# --- minimal perfect hash ----------------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(28)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _prints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys ^ np.uint64(0xA5A5A5A55A5A5A5A)) >> np.uint64(32)).astype(np.uint32)


def _place(hashes: np.ndarray, seed: np.ndarray | int, n: int) -> np.ndarray:
    return (_mix(hashes + np.uint64(0x632BE59BD9B4E019) * np.asarray(seed, np.uint64)) % np.uint64(n)).astype(np.int64)


def _keys(doc_ids: np.ndarray) -> np.ndarray:
    """64-bit keys of sorted doc_ids; the second and later rows of one doc_id get keys of their own."""
    keys = doc_ids.astype(np.int64).view(np.uint64).copy()
    fresh = np.append(True, np.diff(doc_ids) != 0)[:len(keys)]
    if not fresh.all():
        at = np.arange(len(keys))
        nth = at - np.maximum.accumulate(np.where(fresh, at, 0))
        keys = np.where(nth > 0, _mix(keys) + _mix(nth.astype(np.uint64)), keys)
    return keys


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds per bucket and the slot of each of the distinct 64-bit keys."""
    n = len(keys)
    hashes = _mix(keys)
    buckets = (hashes >> np.uint64(33)).astype(np.int64) % max(1, -(-n // _PER_BUCKET))
    seeds = np.zeros(max(1, -(-n // _PER_BUCKET)), np.uint32)
    slot_of, used = np.empty(n, np.int64), np.zeros(n, bool)
    order = np.argsort(buckets, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(buckets[order])) + 1)
    for members in sorted(parts, key=len, reverse=True):  # crowded buckets choose first
        own, tried = hashes[members], 0
        while True:
            seeds_tried = np.arange(tried, tried + 64)
            places = _place(own[None, :], seeds_tried[:, None], n)
            free = ~used[places].any(axis=1)
            if len(members) > 1:
                sorted_places = np.sort(places, axis=1)
                free &= (np.diff(sorted_places, axis=1) > 0).all(axis=1)
            if free.any():
                found = int(free.argmax())
                seeds[buckets[members[0]]] = tried + found
                slot_of[members] = places[found]
                used[places[found]] = True
                break
            tried += 64
            if tried > 1 << 22:
                raise ValueError("keys of a shard are not distinct")
    return seeds, slot_of


def find_slots(keys: np.ndarray, seeds: np.ndarray, n_keys: int) -> np.ndarray:
    hashes = _mix(keys)
    return _place(hashes, seeds[(hashes >> np.uint64(33)).astype(np.int64) % len(seeds)], n_keys)


class Shard:
    """Keyed access to one shard row."""

    def __init__(self, row: dict):
        self.seeds, self.slots = np.frombuffer(row["seeds"], "<u4"), np.frombuffer(row["slots"], _SLOT)
        self.ids = np.frombuffer(row["payload"], f"<u{row['id_bytes']}")
        self.end_id = row["end_id"]

    def where(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of ids of each key; -1 and 0 for keys that the shard does not hold."""
        keys = np.asarray(keys).astype(np.uint64)
        if not len(self.slots):
            return np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        slots = self.slots[find_slots(keys, self.seeds, len(self.slots))]
        known = slots["print"] == _prints(keys)
        return np.where(known, slots["start"].astype(np.int64), -1), np.where(known, slots["count"].astype(np.int64), 0)

    def ids_of(self, key: int) -> np.ndarray | None:
        start, count = self.where(_keys(np.array([key], np.int64)))
        return None if start[0] < 0 else self.ids[start[0]:start[0] + count[0]]


# --- encoding ----------------------------------------------------------------------------------------

class _Memory:
    """Two generations of remembered values: what is used moves to the newer, the older is forgotten when
    the newer holds ``most``."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def age(self) -> None:
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}

    def missing(self, keys: set) -> list:
        """Keys that neither generation holds, after moving the others to the newer."""
        unknown = []
        for key in keys:
            value = self.old.get(key)
            if value is None:
                unknown.append(key)
            else:
                self.new[key] = value
        return unknown


class WordEncoder:
    """Byte-level BPE ids of whole texts, as bytes, by the ``tokenizers`` library.

    The pre-tokeniser of such a vocabulary always cuts before a blank or line end that no white space follows, and ids
    never depend on anything beyond a cut.  So texts are cut there; the pieces of many texts are numbered, each different
    one is cut on into the pre-tokens of the vocabulary, each different pre-token is encoded once by the library, many in a
    call, and both are remembered within bounds.  A piece goes by its text without the blank, or with its line end; a mark
    after a letter and before a blank or line end is a piece of its own, and goes by itself after ``_BARE``.
    """

    # fixed value: the pre-token pattern of byte-level BPE vocabularies
    _PRE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    _BARE, _MARK = "\x01", "([A-Za-zÀ-ÖØ-öø-ɏ])([,.;:!?]) "
    _CUT = re.compile(r" (?=\S)|(?=\n\S)")

    def __init__(self, path: str, most: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # names of added tokens ("<|endoftext|>") stand for those tokens, as the library has it
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces, self.tokens = _Memory(most), _Memory(most)
        self.blank = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.blank[number] = token.startswith("Ġ")  # how byte-level pieces spell a blank
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.marks = {mark: self._ids(mark).tobytes() for mark in _MARKS}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.type)  # no offsets

    def _many(self, words: list[str], bare: bool) -> Iterator[tuple[str, bytes]]:
        """(word, ids) of words of letters, bare or with a blank before each."""
        size = self.type.itemsize
        for at in range(0, len(words), 2000):
            some = words[at:at + 2000]
            ids = self._ids("\n".join(some) if bare else " " + " ".join(some))
            ends = np.flatnonzero(ids == self.line[0]) if bare else np.flatnonzero(self.blank[ids])[1:]
            starts, ends = np.append(0, ends + bare) * size, np.append(ends, len(ids)) * size
            raw = ids.tobytes()
            yield from zip(some, [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())], strict=True)

    def _learn_words(self, words: list[str], into: dict[str, bytes]) -> None:
        """Ids of words of letters only, each with a blank before it: one pre-token each."""
        into.update(self._many(words, False))

    def _learn_tokens(self, tokens: set[str]) -> None:
        """Ids of pre-tokens: words with and without a blank many at a time, all others one by one."""
        unknown, words = self.tokens.missing(tokens), self.pieces.new
        rest = []
        for t in unknown:
            if t[0] == " " and (ids := words.get(t[1:])) is not None:
                self.tokens.new[t] = ids
            else:
                rest.append(t)
        led = [t for t in rest if t[0] == " " and t[1:].isalpha()]
        bare = [t for t in rest if t.isalpha()]
        self.tokens.new.update((" " + word, ids) for word, ids in self._many([t[1:] for t in led], False))
        self.tokens.new.update(self._many(bare, True))
        for t in set(rest).difference(led, bare):
            self.tokens.new[t] = self._ids(t).tobytes()

    def _learn(self, pieces: dict[str, str], into: dict[str, bytes]) -> None:
        """Ids of pieces (name to text)."""
        cut = {}
        for name, text in pieces.items():
            if text.replace("\n", "").isprintable():
                cut[name] = self._PRE.findall(text)
            else:  # blanks on which libraries may differ
                into[name] = self._ids(text).tobytes()
        self.tokens.age()
        self._learn_tokens({t for tokens in cut.values() for t in tokens if t not in self.tokens.new})
        known = self.tokens.new
        for name, tokens in cut.items():
            into[name] = b"".join([known[t] for t in tokens])

    def _learn_lines(self, pieces: list[str], into: dict[str, bytes]) -> None:
        """Ids of words of letters, each with a line end before it."""
        line = np.array(self.line, self.type).tobytes()
        into.update(("\n" + word, line + ids) for word, ids in self._many([p[1:] for p in pieces], True))

    def _learn_tailed(self, pieces: list[str], into: dict[str, bytes]) -> list[str]:
        """Ids of words of letters with one mark after them, from those of the word; returns the other pieces."""
        tailed = [p for p in pieces if p[-1] in _MARKS and (p[1:-1] if p[0] == "\n" else p[:-1]).isalpha()]
        words = self.pieces.missing({p[:-1] for p in tailed if p[:-1] not in into})
        self._learn_words([w for w in words if w[0] != "\n"], into)
        self._learn_lines([w for w in words if w[0] == "\n"], into)
        into.update((p, into[p[:-1]] + self.marks[p[-1]]) for p in tailed)
        return [p for p in pieces if p not in into]

    def encode(self, texts: list[str]) -> list[bytes]:
        collecting = gc.isenabled()
        gc.disable()  # many short-lived lists and no cycles
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        self.pieces.age()
        known, heads = self.pieces.new, {}
        known.update((self._BARE + mark, ids) for mark, ids in self.marks.items())
        lines = pc.replace_substring(pa.array(texts, pa.string()), "\n", " \n")
        cut = pc.split_pattern(pc.replace_substring_regex(lines, self._MARK, rf"\1 {self._BARE}\2 "), " ")
        flat, starts = cut.flatten(), cut.offsets.to_numpy()
        first, body = flat.take(pa.array(starts[:-1])).to_pylist(), np.ones(len(flat), bool)
        body[starts[:-1]] = False
        numbered = flat.filter(pa.array(body)).dictionary_encode()
        names, numbers = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()  # to_pylist is slow
        starts = starts - np.arange(len(starts))  # of the bodies

        # cut where white space follows, or with the name of an added token
        begin = pc.utf8_slice_codeunits(numbered.dictionary, 0, 2).dictionary_encode()
        odd = [not n or (n == "\n" or n[1].isspace() if n[0] == "\n" else n[0].isspace()) for n in begin.dictionary.to_pylist()]
        odd = np.array(odd, bool)[begin.indices.to_numpy()]
        odd = set((np.searchsorted(starts, np.flatnonzero(odd[numbers]), "right") - 1).tolist()) if odd.any() else set()
        whole = {i: self._ids(t).tobytes() for i, t in enumerate(texts) if self._BARE in t or any(name in t for name in self.added)}
        apart = {i: self._CUT.split(texts[i]) for i in odd.difference(whole)}
        for i, pieces in apart.items():
            first[i] = pieces.pop(0)
        if odd or whole:
            used = np.ones(len(texts), bool)
            used[list(odd.union(whole))] = False
            used = set(np.unique(numbers[np.repeat(used, np.diff(starts))]).tolist())
            names = [n if i in used else "" for i, n in enumerate(names)]

        values = list(map(known.get, names))
        unmet = [i for i, value in enumerate(values) if value is None]
        unknown = {names[i] for i in unmet}.union(n for n in chain(*apart.values()) if n not in known)
        unknown.discard("")
        unknown = self.pieces.missing(unknown)
        self._learn_words([p for p in unknown if p.isalpha()], known)
        self._learn_lines([p for p in unknown if p[0] == "\n" and p[1:].isalpha()], known)
        rest = self._learn_tailed([p for p in unknown if p not in known], known)
        self._learn({p: p if p[0] == "\n" else " " + p for p in rest}, known)
        self._learn({text: text for text in first}, heads)  # these have no blank before them
        for i in unmet:
            values[i] = known[names[i]] if names[i] else b""
        ids = pa.array(values, pa.large_binary()).take(numbered.indices)
        raw, ends = ids.buffers()[2], np.frombuffer(ids.buffers()[1], np.int64)[starts].tolist()
        out = [heads[head] + raw[a:b].to_pybytes() for head, a, b in zip(first, ends, ends[1:])]
        for i, pieces in apart.items():
            out[i] = b"".join([heads[first[i]], *map(known.__getitem__, pieces)])
        return [whole.get(i, raw) for i, raw in enumerate(out)]


_ENCODERS: dict[str, WordEncoder] = {}  # one per worker process and vocabulary


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def make_shard(shard: int, doc_ids: np.ndarray, encoded: list[bytes], id_type: np.dtype, end_id: int, part: int = 0) -> dict:
    """One shard row from documents in order."""
    end = np.array([end_id], id_type).tobytes()
    payload = end.join(encoded) + end
    counts = np.array([len(e) for e in encoded], np.int64) // id_type.itemsize + 1
    starts = np.cumsum(counts) - counts
    keys = _keys(doc_ids)
    seeds, slot_of = build_index(keys)
    slots = np.zeros(len(keys), _SLOT)
    slots["start"][slot_of] = starts
    slots["count"][slot_of] = counts
    slots["print"][slot_of] = _prints(keys)
    return {"shard": shard, "part": part, "n_docs": len(doc_ids), "n_tokens": int(counts.sum()),
            "id_bytes": id_type.itemsize, "end_id": end_id, "doc_ids": doc_ids.astype("<i8").tobytes(),
            "seeds": seeds.astype("<u4").tobytes(),
            "slots": slots.tobytes(), "payload": payload}


_SHARD_TYPE = pa.schema([("shard", pa.int64()), ("part", pa.int32())] + [(n, pa.int64()) for n in ("n_docs", "n_tokens")] + [("id_bytes", pa.int32()), (
    "end_id", pa.int64())] + [(n, pa.binary()) for n in ("doc_ids", "seeds", "slots", "payload")])


def _parts(sizes: DataFrame, most_bytes: int) -> DataFrame:
    """doc_id and part of the documents in ranges of more than ``most_bytes``, by running sums of their sizes."""
    heavy = sizes.groupBy("shard").agg(F.sum("bytes").alias("all")).where(F.col("all") > most_bytes).select("shard")
    per_id = sizes.join(heavy, "shard", "left_semi").groupBy("shard", "doc_id").agg(F.sum("bytes").alias("bytes"))
    before = F.sum("bytes").over(Window.partitionBy("shard").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1))
    return per_id.select("doc_id", F.floor(F.coalesce(before, F.lit(0)) / most_bytes).cast("int").alias("part"))


def token_shards(docs: DataFrame, tokenizer: str, end_id: int = 2, width: int = WIDTH, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The shards of ``docs`` (doc_id, text)."""

    def build(key: tuple, group: pa.Table) -> pa.Table:
        order = group.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        encoder = _encoder(tokenizer)
        encoded = encoder.encode(order["text"].to_pylist())
        row = make_shard(key[0].as_py(), order["doc_id"].to_numpy(), encoded, encoder.type, end_id, key[1].as_py())
        return pa.Table.from_pylist([row], schema=_SHARD_TYPE)

    rows = docs.where("doc_id IS NOT NULL").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.floor(F.col("doc_id") / width).cast("long").alias("shard"))
    parts = Stored(docs.sparkSession, "token-parts").save(
        _parts(rows.select("doc_id", "shard", F.octet_length("text").alias("bytes")), most_bytes), "parts")
    if parts.count() <= BROADCAST_PARTS:  # as a rule there are few: texts are then exchanged once
        parts = F.broadcast(parts)
    placed = rows.join(parts, "doc_id", "left").select("doc_id", "text", "shard", F.coalesce("part", F.lit(0)).alias("part"))
    return placed.groupBy("shard", "part").applyInArrow(build, SHARD)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, width: int = WIDTH, most_bytes: int = MOST_BYTES) -> None:
    token_shards(docs, tokenizer, end_id, width, most_bytes).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """shard, part and base: the number of ids in all shards before it.  Sums run within blocks of shards,
    then over one row per block."""
    sizes = shards.select("shard", "part", "n_tokens", F.floor(F.col("shard") / BLOCK).alias("block"))
    inner = Window.partitionBy("block").orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy("block").agg(F.sum("n_tokens").alias("n"))
    blocks = blocks.select("block", F.coalesce(F.sum("n").over(
        Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(blocks, "block").select(
        "shard", "part", (F.col("before") + F.col("inside")).alias("base"))


def token_documents(shards: DataFrame) -> DataFrame:
    """doc_id, shard and part, start in the shard, n_tokens and ids_crc32 of every document, each found by its key."""

    def look_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for row in batch.to_pylist():
            shard, ids = Shard(row), np.frombuffer(row["doc_ids"], "<i8")
            start, count = shard.where(_keys(ids))
            raw = shard.ids.astype("<u4")
            crcs = [zlib.crc32(raw[a:a + n]) for a, n in zip(start.tolist(), count.tolist())]
            parts.append((ids, np.full(len(ids), row["shard"]), np.full(len(ids), row["part"]), start, count, np.array(crcs, np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)],
                                          names=["doc_id", "shard", "part", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(per_batch(look_up), "doc_id long, shard long, part long, start long, n_tokens long, ids_crc32 long")


def corpus_positions(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, read from the files."""
    return token_documents(shards).join(shard_starts(shards), ["shard", "part"]).select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
