"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

A document is the set of its distinct word shingles (``width`` words, A-Z lowered; a shorter text is one
shingle), held as 64-bit hashes.  Two documents are linked if their sets overlap by ``similarity`` or more
(intersection over union); classes are what links connect.

1. Documents with equal sets form a class of copies at once; only one of each goes on.
2. ``bands`` bands of ``rows`` MinHash values put similar sets into common buckets (a pair at the threshold
   shares none with probability (1 - similarity**rows)**bands, 3e-6 by default).
3. Pairs of a bucket are compared signature batch by signature batch.  After each batch the posterior that
   the similarity reaches the threshold, given the matches so far and a uniform prior, is compared with
   ``miss``; below it the pair is dropped (BayesLSH).
4. Survivors are confirmed on the full shingle sets of their whole texts.

A bucket never lists all its pairs.  First all members meet the bucket's first member.  Where that leaves
several classes, the shingles of the members are counted over all documents in such buckets, and the members
meet the bucket's core, the one that shares the largest part of its shingles; then every member outside the
bucket's largest class meets the members of other classes.  Both times a pair is left out if it is connected
already or if the shingles that either shares with any document at all are too few for the threshold; so no
link between classes is lost.

Rows: NULL, empty and blank texts have no shingles and link with nothing; rows without a doc_id are left
out; rows that repeat a doc_id count as one document when links are followed; an empty table gives no rows.
Extra columns are ignored by ``near_duplicates`` and kept by ``keep_first``.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import TEXTS, Stored, binary_text, per_batch, words
from .links import components


@dataclass(frozen=True)
class NearDedup:
    """width: words of a shingle; similarity in percent; bands x rows MinHash values, compared ``batch`` at a
    time; miss: posterior below which a pair is dropped; more: further MinHash values of documents in buckets
    that several classes share; block: members of a bucket compared in one group."""

    width: int = 5
    similarity: int = 80
    bands: int = 32
    rows: int = 5
    batch: int = 32
    miss: float = 1e-5
    more: int = 160
    block: int = 512
    seed: int = 7


SALTS = 16  # tasks that the copies of one text are dealt to
BROADCAST_IDS = 1_000_000  # most ids sent to all tasks


class _WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    found = words(text)
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.array([_HASHES[w] for w in found], np.uint64)
    n = max(1, len(hashes) - width + 1)
    value = hashes[:n].copy()
    for k in range(1, min(width, len(hashes))):
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[k:n + k]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0x94D049BB133111EB)
    return np.unique(value ^ (value >> np.uint64(29)))


class _MinHash:
    def __init__(self, size: int, seed: int):
        draw = np.random.default_rng(seed)
        self.times = draw.integers(1, 2**63, size, np.uint64) | np.uint64(1)
        self.plus = draw.integers(0, 2**63, size, np.uint64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        best = np.full(len(self.times), 2**64 - 1, np.uint64)
        for at in range(0, len(hashes), 512):  # stays in the cache
            np.minimum(best, (hashes[at:at + 512, None] * self.times + self.plus).min(axis=0), out=best)
        return (best >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, of: NearDedup) -> DataFrame:
    """doc_id, n_shingles, same (digest of the set; NULL for an empty one) and the MinHash signature."""
    hasher = _MinHash(of.bands * of.rows, of.seed)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, same, signature = [], [], []
        for text in batch["utf8"].to_pylist():
            own = shingles(text, of.width)
            sizes.append(len(own))
            same.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
            signature.append(hasher(own).tobytes() if len(own) else None)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(same, pa.binary()), pa.array(signature, pa.binary())],
            names=["doc_id", "n_shingles", "same", "signature"])

    return docs.where("doc_id IS NOT NULL").select("doc_id", binary_text().alias("utf8")).mapInArrow(
        per_batch(work, TEXTS), "doc_id long, n_shingles long, same binary, signature binary")


def least_matches(of: NearDedup, total: int | None = None) -> list[tuple[int, int]]:
    """After n compared values, the fewest matches m at which P(similarity >= threshold | m of n) >= miss.

    With a uniform prior the posterior tail at t is P(Binomial(n + 1, t) <= m).
    """
    t, total = of.similarity / 100, total or of.bands * of.rows
    out = []
    for n in [*range(of.batch, total, of.batch), total]:
        tail, m = 0.0, -1
        while tail < of.miss:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def _plausible(pairs: DataFrame, signed: DataFrame, of: NearDedup) -> DataFrame:
    """The pairs (a, b) whose signatures leave the threshold possible."""
    steps = least_matches(of)
    size = of.bands * of.rows

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(-1, size) for c in ("sa", "sb"))
        alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
        for n, least in steps:  # sequential: each batch is compared for the pairs still alive
            matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
            alive, done = alive[matches[alive] >= least], n
        kept = pa.array(alive)
        return pa.RecordBatch.from_arrays([batch["a"].take(kept), batch["b"].take(kept)], names=["a", "b"])

    a, b = (signed.select(F.col("rep").alias(c), F.col("signature").alias(f"s{c}")) for c in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(per_batch(work), "a long, b long")


def _in_blocks(members: DataFrame, of: NearDedup) -> DataFrame:
    """Plausible pairs (a, b) between a member outside its bucket's largest class and members of other classes.

    A bucket is cut into blocks of about ``block`` members; every two blocks meet in one group of bounded size,
    where signatures are compared in matrices, so pairs that cannot be links never become rows.  A pair that
    shares several bands is handled in the first.
    """
    size = of.bands * of.rows + of.more
    steps = least_matches(of, size)
    counts = members.groupBy("key").agg(F.ceil(F.count("*") / of.block).cast("int").alias("blocks"))
    dealt = members.join(counts, "key").withColumn("own", F.pmod(F.xxhash64("rep"), "blocks").cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep",
                         "class", "main", "n", F.coalesce("shared", F.lit(-1)).alias("shared"), "signature")
    nothing = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    def work(group: pa.Table) -> pa.Table:
        rep, kind, main, n, shared, own = (group[c].to_numpy() for c in ("rep", "class", "main", "n", "shared", "own"))
        i, j, band = group["i"][0].as_py(), group["j"][0].as_py(), group["band"][0].as_py()
        values = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint32).reshape(-1, size)
        before = np.ascontiguousarray(values[:, :band * of.rows])
        found = []
        for row in np.flatnonzero(kind != main).tolist():
            most = np.minimum(shared, shared[row])
            # the other block, or this one; two outsiders of one block meet once
            others = np.flatnonzero(((own != own[row]) | (i == j)) & (kind != kind[row]) & ((kind == main) | (rep > rep[row])) & (
                (most < 0) | (100 * most >= of.similarity * (n + n[row] - most))))
            matches, done = np.zeros(len(others), np.int64), 0
            for upto, least in steps:
                matches += (values[others, done:upto] == values[row, done:upto]).sum(axis=1)
                keep = matches >= least
                others, matches, done = others[keep], matches[keep], upto
                if not len(others):
                    break
            if len(others) and band:
                same = (before[others] == before[row]).reshape(len(others), band, of.rows).all(axis=2).any(axis=1)
                others = others[~same]
            if len(others):
                found.append(np.stack([np.minimum(rep[others], rep[row]), np.maximum(rep[others], rep[row])]))
        if not found:
            return nothing
        a, b = np.concatenate(found, axis=1)
        return pa.table({"a": a[a != b], "b": b[a != b]})

    return dealt.groupBy("key", "i", "j").applyInArrow(work, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, of: NearDedup) -> DataFrame:
    """The pairs (a, b) whose full shingle sets overlap enough."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def of_text(text: bytes) -> np.ndarray:
            if text not in known:
                known[text] = shingles(text, of.width)
                if len(known) > 256:
                    known.popitem(last=False)
            return known[text]

        kept = []
        for i, (x, y) in enumerate(zip(batch["ta"].to_pylist(), batch["tb"].to_pylist())):
            x, y = of_text(x), of_text(y)
            if min(len(x), len(y)) * 100 < of.similarity * max(len(x), len(y)):
                continue
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= of.similarity * (len(x) + len(y) - common):
                kept.append(i)
        kept = pa.array(kept, pa.int64())
        return pa.RecordBatch.from_arrays([batch["a"].take(kept), batch["b"].take(kept)], names=["a", "b"])

    a, b = (texts.select(F.col("rep").alias(c), F.col("utf8").alias(f"t{c}")) for c in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(per_batch(work, TEXTS), "a long, b long")


def _more(texts: DataFrame, of: NearDedup) -> DataFrame:
    """rep and further MinHash values of the texts."""
    hasher = _MinHash(of.more, of.seed + 1)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [hasher(shingles(t, of.width)).tobytes() for t in batch["utf8"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["rep"], pa.array(values, pa.binary())], names=["rep", "more"])

    return texts.select("rep", "utf8").mapInArrow(per_batch(work, TEXTS), "rep long, more binary")


def _shared(texts: DataFrame, of: NearDedup) -> DataFrame:
    """rep, n (shingles) and shared (those that another of the texts has too), NULL for reps with several texts."""

    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                some = batch.slice(at, TEXTS)
                reps = some["rep"].to_numpy()
                sets = [shingles(t, of.width) for t in some["utf8"].to_pylist()]
                low, sizes = 0, np.cumsum([len(s) for s in sets])
                while low < len(sets):  # a bounded number of rows at a time
                    high = max(low + 1, int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + 500_000, "right")))
                    part = sets[low:high]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(reps[low:high], [len(s) for s in part])), pa.array(np.concatenate(part).view(np.int64))],
                        names=["rep", "shingle"])
                    low = high

    rows = texts.select("rep", "utf8").mapInArrow(work, "rep long, shingle long")
    common = rows.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    seen = rows.join(common, "shingle", "left").groupBy("rep").agg(F.count("*").alias("n"), F.count("times").alias("shared"))
    several = texts.groupBy("rep").agg(F.count("*").alias("texts"))
    return seen.join(several, "rep").select("rep", "n", F.when(F.col("texts") == 1, F.col("shared")).alias("shared"))


def _copies(signed: DataFrame) -> DataFrame:
    """Documents with a set, their ``rep`` (the smallest doc_id of equal sets), and the signature of representatives.

    Only sets that occur again are looked up, and their representatives are dealt over ``SALTS`` tasks, so the
    copies of one text meet theirs in many places.
    """
    signed = signed.where("same IS NOT NULL")
    again = signed.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("times")).where("times > 1")
    again = again.select("same", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = signed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    rep = F.coalesce("first", "doc_id")
    met = dealt.select("doc_id", "n_shingles", "same", "salt", "signature").join(again, ["same", "salt"], "left")
    return met.select("doc_id", "n_shingles", rep.alias("rep"), F.when(F.col("doc_id") == rep, F.col("signature")).alias("signature"))


def near_duplicates(docs: DataFrame, of: NearDedup = NearDedup(), store: Stored | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id connected) and kept (whether it is that document)."""
    store = store or Stored(docs.sparkSession, "near")
    signed = store.save(signatures(docs, of), "signed")
    copies = store.save(_copies(signed), "copies")
    single = signed.where("same IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    reps = copies.where("signature IS NOT NULL").select("rep", "signature")

    width = 4 * of.rows  # bytes of a band
    bands = reps.select("rep", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(of.bands - 1)),
        lambda k: F.xxhash64(k, F.substring("signature", k * width + 1, F.lit(width))))).alias("band", "key"))
    crowded = bands.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").drop("high")
    members = store.save(bands.join(crowded, "key"), "members")

    busy = members.select("rep").distinct()
    reps = store.save(reps.join(busy, "rep").dropDuplicates(["rep", "signature"]), "busy")
    utf8 = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("rep"), binary_text().alias("utf8"))
    texts = store.save(utf8.join(busy, "rep").withColumn("print", F.xxhash64("utf8")).dropDuplicates(["rep", "print"])
                       .drop("print"), "texts")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        likely = store.save(_plausible(pairs, reps, of), f"{name}-likely")
        return store.save(_confirmed(likely, texts, of), f"{name}-sure")

    def unsettled(found: DataFrame, name: str) -> DataFrame:
        """Members of buckets that more than one class shares, with their class and the bucket's largest."""
        now = members.join(found, members["rep"] == found["node"], "left").select(
            "key", "band", "rep", "low", F.coalesce("component", "rep").alias("class"))
        now = store.save(now, f"{name}-members")
        sizes = now.groupBy("key", "class").agg(F.count("*").alias("n"))
        shared = sizes.groupBy("key").agg(F.max(F.struct("n", "class")).alias("top"), F.count("*").alias("classes")).where(
            "classes > 1").select("key", F.col("top.class").alias("main"))
        return store.save(now.join(shared, "key"), f"{name}-open")

    def possible(a: str, b: str):
        """Whether the shared shingles of both leave the threshold possible (true where they are not known)."""
        most = F.least(f"{a}.shared", f"{b}.shared")
        return F.coalesce(100 * most >= of.similarity * (F.col(f"{a}.n") + F.col(f"{b}.n") - most), F.lit(True))

    links = linked(members.select(F.col("rep").alias("a"), F.col("low").alias("b")), "low")
    found = components(links, store, "low")

    left = unsettled(found, "core")
    known = store.save(_shared(texts.join(left.select("rep").distinct(), "rep"), of), "shared")
    left = left.where("rep <> low").join(known, "rep")  # the first member has met all others
    core = F.max(F.struct(F.col("shared") / F.col("n"), "rep", "class", "n", "shared")).alias("core")
    cores = left.groupBy("key").agg(core).select("key", "core.rep", "core.class", "core.n", "core.shared")
    near_core = left.alias("x").join(cores.alias("y"), "key").where(
        (F.col("x.class") != F.col("y.class")) & possible("x", "y"))
    more = linked(near_core.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")), "core")
    if not more.isEmpty():
        links = links.unionByName(more)
        found = components(links, store, "core")

    left = unsettled(found, "rest").where("rep <> low").join(known, "rep")
    signed = reps.join(store.save(_more(texts.join(left.select("rep").distinct(), "rep"), of), "more"), "rep")
    left = left.join(signed.select("rep", F.concat("signature", "more").alias("signature")), "rep")
    likely = store.save(_in_blocks(left, of).distinct(), "rest-likely")
    more = store.save(_confirmed(likely, texts, of), "rest-sure")
    if not more.isEmpty():
        found = components(links.unionByName(more), store, "rest")

    joined = copies.join(found, copies["rep"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    return joined.unionByName(single).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_first(docs: DataFrame, of: NearDedup = NearDedup()) -> DataFrame:
    """The rows of ``docs`` without those near an earlier one; rows without a doc_id stay, of rows that
    repeat a doc_id one stays."""
    store = Stored(docs.sparkSession, "near")
    found = Stored(docs.sparkSession, "classes").save(near_duplicates(docs, of, store), "classes")
    store.drop_all()
    again = found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id")
    gone = found.where("NOT kept").select("doc_id")

    def small(ids: DataFrame) -> DataFrame:
        """Ids that are few enough go to all tasks, so that texts stay where they are; others are joined by exchange."""
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    if again.isEmpty():
        return docs.join(small(gone), "doc_id", "left_anti").select(docs.columns)
    once = docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    return docs.join(small(gone.unionByName(again)), "doc_id", "left_anti").select(docs.columns).unionByName(once)
