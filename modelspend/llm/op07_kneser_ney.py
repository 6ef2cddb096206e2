"""LM scoring: an interpolated modified Kneser-Ney bigram model.

Counting runs in Spark over all training texts.  A first pass counts words;
their sorted 64-bit hashes give each word a number.  A second pass counts
bigrams: each task sums its own, then sends them, packed, to shards of about
``SHARD_BYTES`` of text by their first word.  Bigrams of a word so common that it
alone would fill a shard go by their second word instead, so no word gathers in
one task.  Each shard is stored as a sorted array of bigrams with their counts
in the shared folder, and beside it stand arrays by word: its count, how many
different words it follows, and how many words follow it once, twice and more.
Workers map these files into memory and look up sorted batches, so scoring
needs no shuffle and no worker loads the model.

p(w | h) = max(c(hw) - D(c), 0) / c(h) + g(h) p(w), where g(h) is what the
discounts took from h's bigrams, and p(w) is the same over the number of
different words before w, down to 1 / (V + 1) for each word and any unknown
one.  Discounts D1, D2, D3+ come from the counts of counts.

Files are written under another name and renamed, so a task that is run again
or lost leaves whole files only.  The model needs a folder that all workers
mount; ``folder`` names one if ``spark.checkpoint.dir`` isn't such a path.

Edge cases: null text is empty (its one token is the end); without training
texts every token is unknown; repeated rows count and are scored each; a null
doc_id is never held out and has the score of its text; an empty table gives no
rows; other columns are ignored; whole texts are read.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelspend.llm.shared import joined_bytes, read_table, shared_folder, stage, text_blocks
from modelspend.llm.words import NOT_SPACE, mix, word_bounds, word_hashes

FOLDS, HELD_OUT = 7, 2
SHARD_BYTES = 16 << 20
#: Words in one file of the arrays by word.
RANGE = 1 << 20
#: The end of a text, as a word's hash; no word has it, since words' hashes pass through here as well.
END = np.uint64(0x5EED0E4DFACE0FF1)
HELD_ENTRIES = 3_000_000


# ------------------------------------------------------------------------ files


def local_folder(uri: str) -> str:
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"workers cannot map files in {uri}; give a folder that all of them mount")
    return parts.path


def write_array(path: str, values: np.ndarray) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        out.write(values.tobytes())
    os.replace(part, path)


def read_array(path: str, kind: type) -> np.ndarray:
    """A mapped file; empty files can't be mapped."""
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.zeros(0, kind)
    return np.memmap(path, kind, "r")


@dataclass
class Model:
    """Where the arrays are, and the few numbers that go to every worker."""

    folder: str
    shards: int
    #: First number of the words of each hash range, and their end.
    base: list[int]
    tokens: int
    #: Numbers of the words that are too common for one shard.
    common: np.ndarray
    training_texts: int = 0
    #: D1, D2, D3+ of bigrams and of words.
    discounts: np.ndarray = field(default_factory=lambda: np.zeros(3))
    lower: np.ndarray = field(default_factory=lambda: np.zeros(3))
    #: Number of different bigrams, and words by D class: what the lower order distributes.
    bigrams: int = 0
    classes: tuple[int, int, int] = (0, 0, 0)
    _open: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    @property
    def words(self) -> int:
        return self.base[-1]

    @property
    def start(self) -> int:
        """The number of the place before a text."""
        return self.words

    def array(self, name: str, kind: type) -> np.ndarray:
        if name not in self._open:
            self._open[name] = read_array(f"{self.folder}/{name}", kind)
        return self._open[name]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 if it has none; ``hashes`` are sorted."""
        out = np.full(len(hashes), -1)
        bits = (len(self.base) - 1).bit_length() - 1
        cuts = np.array([0, len(hashes)])
        if bits:
            cuts = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange(len(self.base), dtype=np.uint64))
        for r in range(len(self.base) - 1):
            part = hashes[cuts[r] : cuts[r + 1]]
            known = self.array(f"hash-{r}", np.uint64)
            if len(part) and len(known):
                at = np.searchsorted(known, part)
                at[at == len(known)] = 0
                out[cuts[r] : cuts[r + 1]] = np.where(known[at] == part, at + self.base[r], -1)
        return out

    def by_word(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """Values of an array by word; ``numbers`` are sorted and known."""
        out = np.zeros(len(numbers), np.int64)
        for r in np.unique(numbers // RANGE).tolist():
            low, high = np.searchsorted(numbers, [r * RANGE, (r + 1) * RANGE])
            out[low:high] = self.array(f"{name}-{r}", np.int64)[numbers[low:high] - r * RANGE]
        return out

    def shard(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The shard of each bigram."""
        by = first
        if len(self.common):
            at = np.searchsorted(self.common, first)
            at[at == len(self.common)] = 0
            by = np.where(self.common[at] == first, second, first)
        return (mix(by.astype(np.uint64)) % np.uint64(self.shards)).astype(np.int64)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """How often each bigram was seen; ``keys`` are sorted and distinct."""
        out = np.zeros(len(keys), np.int64)
        shard = self.shard((keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
        order = np.argsort(shard.astype(np.uint16) if self.shards < 1 << 16 else shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.unique(shard).tolist():
            which = order[cuts[s] : cuts[s + 1]]
            known = self.array(f"bigram-{s}", np.uint64)
            if len(known):
                at = np.searchsorted(known, keys[which])
                at[at == len(known)] = 0
                out[which] = np.where(known[at] == keys[which], self.array(f"count-{s}", np.uint32)[at], 0)
        return out


# ---------------------------------------------------------------------- packing


def sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sum of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and one task's counts, which fit in 32 bits: differences by byte position, compressed."""
    gaps = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    low = counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(gaps.tobytes() + low.tobytes())


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(raw) // 12
    keys = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64).ravel().cumsum(dtype=np.uint64)
    counts = np.ascontiguousarray(raw[8 * n :].reshape(4, n).T).view(np.uint32).ravel()
    return keys, counts.astype(np.int64)


# --------------------------------------------------------------------- counting


def block_words(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a block, and where each text's begin."""
    data, bounds = joined_bytes(block.column("text"))
    starts, ends, first = word_bounds(data, bounds, NOT_SPACE)
    return word_hashes(data, starts, ends), first


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, n) of the task's words and text ends."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = texts = 0

    def rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), 100_000):
            some = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[some].view(np.int64)), pa.array(counts[some])], names=["hash", "n"]
            )

    for block in text_blocks(batches):
        hashes, _ = block_words(block)
        keys, counts = np.unique(hashes, return_counts=True)
        parts.append((keys, counts.astype(np.int64)))
        texts += block.num_rows
        held += len(keys)
        if held > HELD_ENTRIES:
            parts = [sums(*map(np.concatenate, zip(*parts, strict=True)))]
            held = len(parts[0][0])
            if held > HELD_ENTRIES // 2:
                yield from rows(*parts.pop())
                held = 0
    if parts:
        yield from rows(*sums(*map(np.concatenate, zip(*parts, strict=True))))
    if texts:
        yield from rows(np.array([END]), np.array([texts]))


def store_words(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the words of each hash range, sorted; (part, words, tokens) of each range."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, columns in by_part(batches):
            order = np.argsort(hashes := columns["hash"].view(np.uint64))
            write_array(f"{folder}/hash-{part}", hashes[order])
            write_array(f"{folder}/seen-{part}", columns["n"][order])
            yield pa.RecordBatch.from_pydict({"part": [part], "words": [len(order)], "tokens": [int(columns["n"].sum())]})

    return store


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, np.ndarray | list]]]:
    """Rows with the same ``part``, which come one after another, as arrays or lists of bytes."""
    held: list[pa.RecordBatch] = []
    part = None

    def out():
        table = pa.Table.from_batches(held)
        return part, {
            c: table[c].to_pylist() if pa.types.is_binary(table[c].type) else table[c].to_numpy()
            for c in table.column_names
        }

    for batch in batches:
        parts = batch.column("part").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1], [True]])) if len(parts) else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and parts[a] != part:
                yield out()
                held = []
            part = int(parts[a])
            held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield out()


def text_numbers(model: Model, block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all tokens with each text's end, and of the token before each; where each text's begin."""
    hashes, first = block_words(block)
    distinct, place = np.unique(np.append(hashes, END), return_inverse=True)
    numbers = model.numbers(distinct)[place]
    now = np.insert(numbers[:-1], first[1:], numbers[-1])
    before = np.insert(numbers[:-1], first[:-1], model.start)
    return now, before, first + np.arange(len(first))


def count_bigrams(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(part, blob): the task's bigrams, packed for each shard."""

    def rows(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        shard = model.shard((keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(model.shards + 1))
        for s in np.unique(shard).tolist():
            some = order[cuts[s] : cuts[s + 1]]
            blob = pack(keys[some], counts[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int64()), pa.array([blob], pa.binary())], names=["part", "blob"]
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for block in text_blocks(batches):
            now, before, _ = text_numbers(model, block)
            keys = before.astype(np.uint64) << np.uint64(32) | now.astype(np.uint64)
            keys, counts = np.unique(keys, return_counts=True)
            parts.append((keys, counts.astype(np.int64)))
            held += len(keys)
            if held > HELD_ENTRIES:
                yield from rows(*sums(*map(np.concatenate, zip(*parts, strict=True))))
                parts, held = [], 0
        if parts:
            yield from rows(*sums(*map(np.concatenate, zip(*parts, strict=True))))

    return count


STATS = ("number", "once", "twice", "more", "preceded")


def stored_counts(counts: np.ndarray) -> np.ndarray:
    """Counts as they are stored, in 32 bits; one that needs more is refused instead of wrapped."""
    if len(counts) and counts.max() >= 1 << 32:
        raise OverflowError("a bigram occurs over 4294967295 times")
    return counts.astype(np.uint32)


def store_bigrams(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write each shard's bigrams; (part, blobs): by word, the bigrams it begins and ends."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, columns in by_part(batches):
            keys, counts = sums(*map(np.concatenate, zip(*map(unpack, columns["blob"]), strict=True)))
            write_array(f"{model.folder}/bigram-{shard}", keys)
            write_array(f"{model.folder}/count-{shard}", stored_counts(counts))
            first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            levels = [np.bincount(np.minimum(counts, 5), minlength=6)]
            begins, place = np.unique(first, return_inverse=True)
            followed = np.stack([np.bincount(place, c, len(begins)) for c in (counts == 1, counts == 2, counts > 2)], 1)
            ends, preceded = np.unique(second, return_counts=True)
            numbers = np.concatenate([begins, ends])
            values = np.zeros((len(numbers), 4), np.int64)
            values[: len(begins), :3] = followed
            values[len(begins) :, 3] = preceded
            ranges = numbers // RANGE
            for r in np.unique(ranges).tolist():
                some = ranges == r
                blob = np.column_stack([numbers[some], values[some]]).astype(np.int64).tobytes()
                blob = zstandard.ZstdCompressor(level=1).compress(blob)
                yield pa.RecordBatch.from_pydict(
                    {"part": [r], "blob": [blob], "levels": [levels.pop().tolist() if levels else [0] * 6]},
                    schema=pa.schema([("part", pa.int64()), ("blob", pa.binary()), ("levels", pa.list_(pa.int64()))]),
                )

    return store


def store_by_word(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the arrays of each range of words; (levels): counts of the words by how many different words they follow."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, columns in by_part(batches):
            dense = np.zeros((RANGE, 4), np.int64)
            for blob in columns["blob"]:
                rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64).reshape(-1, 5)
                np.add.at(dense, rows[:, 0] - r * RANGE, rows[:, 1:])
            for i, name in enumerate(STATS[1:]):
                write_array(f"{model.folder}/{name}-{r}", dense[:, i])
            seen = np.bincount(np.minimum(dense[:, 3], 5), minlength=6)
            yield pa.RecordBatch.from_pydict(
                {"levels": [seen.tolist()]}, schema=pa.schema([("levels", pa.list_(pa.int64()))])
            )

    return store


def discounts(levels: list[int]) -> np.ndarray:
    """D1, D2, D3+ from the numbers of entries with counts 1 to 4; 0 where the counts say nothing."""
    n1, n2, n3, n4 = (float(x) for x in levels[1:5])
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([min(max(d, 0.05), k) for d, k in zip(raw, (1.0, 2.0, 3.0), strict=True)])


def level_sums(df: DataFrame) -> list[int]:
    row = df.agg(*[F.coalesce(F.sum(F.get("levels", F.lit(i))), F.lit(0)).alias(f"n{i}") for i in range(6)]).first()
    return list(row)


def train(docs: DataFrame, folder: str | None = None) -> Model:
    """Count the texts of ``docs`` and store the model."""
    folder = f"{local_folder(folder or shared_folder(docs.sparkSession))}/kneser-ney-{uuid.uuid4().hex}"
    os.makedirs(folder)
    texts = docs.select("text")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))
    words = texts.mapInArrow(count_words, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    words = stage(words, "words")
    distinct = words.count()
    bits = max(0, (distinct // RANGE).bit_length())
    part = F.shiftrightunsigned("hash", 64 - bits).cast("long") if bits else F.lit(0).cast("long")
    placed = words.select(part.alias("part"), "hash", "n").repartition(1 << bits, "part").sortWithinPartitions("part")
    stored = placed.mapInArrow(store_words(folder), "part bigint, words bigint, tokens bigint")
    ranges = {r.part: r for r in stage(stored, "word-ranges").collect()}  # one row for each range of a million words
    base = [0]
    for r in range(1 << bits):
        base.append(base[-1] + (ranges[r].words if r in ranges else 0))
    tokens = sum(r.tokens for r in ranges.values())
    model = Model(folder, shards, base, tokens, np.zeros(0, np.int64))
    end = words.filter(F.col("hash") == int(END.view(np.int64))).select("n").first()
    texts_seen = end.n if end else 0
    # at most as many words as shards have this share of all tokens
    common = [r.hash for r in words.filter(F.col("n") > tokens // shards).select("hash").collect()]
    numbers = model.numbers(np.sort(np.array(common, np.int64).view(np.uint64)))
    model.common = np.sort(np.append(numbers, model.start)).astype(np.int64)
    packed = texts.mapInArrow(count_bigrams(model), "part bigint, blob binary")
    packed = packed.repartition(shards, "part").sortWithinPartitions("part")
    sharded = packed.mapInArrow(store_bigrams(model), "part bigint, blob binary, levels array<bigint>")
    sharded = stage(sharded, "bigrams-by-word")
    levels = level_sums(sharded)
    by_word = sharded.select("part", "blob").repartition(-(-(distinct + 1) // RANGE), "part").sortWithinPartitions("part")
    lower = level_sums(stage(by_word.mapInArrow(store_by_word(model), "levels array<bigint>"), "word-levels"))
    model.discounts, model.lower = discounts(levels), discounts(lower)
    model.bigrams, model.training_texts = sum(levels), texts_seen
    model.classes = (lower[1], lower[2], sum(lower[3:]))
    return model


# ---------------------------------------------------------------------- scoring


def taken(counts: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The discount of each count."""
    return np.append(0.0, by)[np.minimum(counts, 3)]


def score_texts(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uniform = 1 / (model.words + 1)
        spread = float(np.dot(model.lower, model.classes)) / max(1, model.bigrams) if model.bigrams else 1.0
        for block in text_blocks(batches):
            now, before, first = text_numbers(model, block)
            distinct, place = np.unique(np.concatenate([now, before]), return_inverse=True)
            real = (distinct >= 0) & (distinct < model.words)
            stats = {n: np.zeros(len(distinct), np.int64) for n in ("seen", *STATS[1:])}
            known = distinct >= 0
            if model.bigrams:
                for name in STATS[1:]:
                    stats[name][known] = model.by_word(name, distinct[known])
                stats["seen"][real] = seen_counts(model, distinct[real])
            preceded = stats["preceded"]
            lower = spread * uniform + np.maximum(preceded - taken(preceded, model.lower), 0) / max(1, model.bigrams)
            # every place of a history is followed by some token
            follow = np.stack([stats[n] for n in ("once", "twice", "more")], 1)
            seen = stats["seen"].astype(float)
            seen[distinct == model.start] = model.training_texts
            back = np.where(seen > 0, follow @ model.discounts / np.maximum(seen, 1), 1.0)
            now_at, before_at = place[: len(now)], place[len(now) :]
            both = (now >= 0) & (before >= 0)
            keys = before[both].astype(np.uint64) << np.uint64(32) | now[both].astype(np.uint64)
            pairs, pair = np.unique(keys, return_inverse=True)
            count = np.zeros(len(now), np.int64)
            count[both] = model.counts(pairs)[pair]
            direct = np.maximum(count - taken(count, model.discounts), 0) / np.maximum(seen[before_at], 1)
            chance = np.log10(direct + back[before_at] * lower[now_at])
            base = np.log10((stats["seen"][now_at] + 1) / (model.tokens + model.words + 1))
            total = lambda values, first=first: np.add.reduceat(values, first[:-1]) if len(first) > 1 else values
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    block.column("held_out"),
                    pa.array(np.diff(first)),
                    pa.array(total((now >= 0).astype(np.int64))),
                    pa.array(np.full(len(first) - 1, model.tokens, np.int64)),
                    pa.array(total(base)),
                    pa.array(total(chance)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return score


def seen_counts(model: Model, numbers: np.ndarray) -> np.ndarray:
    """How often each word was seen; ``numbers`` are sorted."""
    out = np.zeros(len(numbers), np.int64)
    cuts = np.searchsorted(numbers, model.base)
    for r in range(len(model.base) - 1):
        if cuts[r] < cuts[r + 1]:
            at = numbers[cuts[r] : cuts[r + 1]] - model.base[r]
            out[cuts[r] : cuts[r + 1]] = model.array(f"seen-{r}", np.int64)[at]
    return out


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of every row; ``docs`` needs doc_id, text and held_out."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return docs.select("doc_id", "text", "held_out").mapInArrow(score_texts(model), schema)


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model of those that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    docs = docs.withColumn("held_out", F.coalesce(fold == HELD_OUT, F.lit(False)))
    return score_documents(docs, train(docs.filter(~F.col("held_out"))))
