"""SentencePiece encoding and decoding: sampled segmentations of whole texts.

The lattice of a text has an edge for each vocabulary piece that matches at a
place.  Forward filtering sums the weights of all paths to each place;
backward sampling then draws, from the end, one piece after the other in
proportion to its share.  The draws come from a counter-based generator seeded by the
row's key, so a row gets the same segmentation wherever and whenever it runs.
A piece's weight is ``(rank + 1) ** -SHARPNESS``; the vocabulary file is used as
it is.

Texts are cut where no piece could reach across, and the lattice of each
distinct cut is built once for a block of texts, with numpy over all cuts of
the block at once.  A cut longer than a window is filtered window by window: only
the weights that the next window needs are kept, and sampling builds each window
again, from the last to the first.  A character without a piece goes to its bytes' pieces.
Spaces are pieces' own; the marker character itself, standing in a text, counts as any
other character, so decoding always gives the text back.

Edge cases: null text is empty and has the one piece of the leading space;
repeated rows get equal segmentations; a null doc_id is a key of its own; an
empty table gives no rows; other columns are ignored; whole texts are encoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise
from math import exp, inf, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelspend.llm.shared import free_name, joined_bytes, read_table, text_blocks
from modelspend.llm.words import mix, prefix_sums, span_hashes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SHARPNESS = 1.0
MARKER = "▁"
SEED = 20
#: Weights of a place's incoming pieces are whole numbers of about this many bits, so draws are exact.
BITS = 31
BLOCK_BYTES = 1 << 20
SLOT_BITS = 18
#: Edges of lattices that a worker keeps for later blocks; beyond them, new cuts' lattices are built for one block.
KEPT_EDGES = 1_500_000
#: Cuts of more bytes are filtered in windows of about as many.
WINDOW_BYTES = 1 << 16
SPACE = 0x20
#: Bytes of a UTF-8 character by its first byte; 0 for the bytes inside one.
CHAR_SIZE = np.array([1] * 0x80 + [0] * 0x40 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10, np.int64)


@dataclass
class Vocabulary:
    """Bytes and log weight of each piece, and its hashed prefixes."""

    start: np.ndarray
    size: np.ndarray
    bytes: np.ndarray
    weight: np.ndarray
    byte_piece: np.ndarray
    prefixes: np.ndarray
    piece_of: np.ndarray
    #: First of the sorted prefixes for each value of their upper bits.
    slots: np.ndarray
    longest: int
    #: Pairs of neighbouring bytes that some piece holds.
    inner: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash among the prefixes, or -1."""
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at, last = self.slots[slot], self.slots[slot + 1]
        out = np.full(len(hashes), -1)
        todo = np.flatnonzero(at < last)
        while len(todo):
            here = at[todo]
            hit = self.prefixes[here] == hashes[todo]
            out[todo[hit]] = here[hit]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < last[todo]]
        return out


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces, usable, byte_piece = [], [], np.zeros(256, np.int64)
    for i in range(n):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_piece[int(name[3:5], 16)] = i
            pieces.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(b"")
        else:
            pieces.append(name.replace(MARKER, " ").encode())
            usable.append(i)
    inner = np.zeros((256, 256), bool)
    for i in usable:
        b = np.frombuffer(pieces[i], np.uint8)
        inner[b[:-1], b[1:]] = True
    data = np.frombuffer(b"".join(pieces[i] for i in usable), np.uint8)
    sizes = np.array([len(pieces[i]) for i in usable])
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes = span_hashes(prefix_sums(data), start, np.arange(len(data)) + 1).tolist()
    prefix = dict.fromkeys(hashes, -1)
    prefix |= {hashes[last - 1]: i for i, last in zip(usable, np.cumsum(sizes).tolist(), strict=True)}
    keys = np.array(sorted(prefix), np.uint64)
    size = np.array([len(b) for b in pieces], np.int64)
    return Vocabulary(
        start=np.concatenate([[0], np.cumsum(size)[:-1]]),
        size=size,
        bytes=np.frombuffer(b"".join(pieces), np.uint8),
        weight=-SHARPNESS * np.log1p(np.arange(n, dtype=float)),
        byte_piece=byte_piece,
        prefixes=keys,
        piece_of=np.array([prefix[k] for k in keys.tolist()], np.int64),
        slots=np.searchsorted(keys >> np.uint64(64 - SLOT_BITS), np.arange((1 << SLOT_BITS) + 1, dtype=np.uint64)),
        longest=int(size[usable].max()),
        inner=inner,
    )


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for the first size, then the next."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def with_leading_space(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text with a space before it."""
    return np.insert(data, bounds[:-1], SPACE), bounds + np.arange(len(bounds))


def cut_starts(data: np.ndarray, bounds: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Starts of the cuts: places at which a character begins and that no piece can cross."""
    free = np.ones(len(data), bool)
    free[1:] = ~vocab.inner[data[:-1], data[1:]]
    free &= CHAR_SIZE[data] > 0
    free[bounds[:-1]] = True
    return np.flatnonzero(free)


@dataclass
class Lattice:
    """Lattices of cuts: edges by node, nodes numbered by cut; ``upto`` adds up the shares of a node's edges."""

    hashes: np.ndarray
    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    total: np.ndarray
    source: np.ndarray
    piece: np.ndarray
    upto: np.ndarray

    def merged(self, other: Lattice) -> Lattice:
        """Both lattices as one, cuts in order of their hashes."""
        nodes, edges = len(self.total), len(self.source)
        hashes = np.concatenate([self.hashes, other.hashes])
        order = np.argsort(hashes)
        return Lattice(
            hashes[order],
            np.concatenate([self.low, other.low + nodes])[order],
            np.concatenate([self.high, other.high + nodes])[order],
            np.concatenate([self.first, other.first + edges]),
            np.concatenate([self.total, other.total]),
            np.concatenate([self.source, other.source + nodes]),
            np.concatenate([self.piece, other.piece]),
            np.concatenate([self.upto, other.upto]),
        )


def edges_of(
    data: np.ndarray, cut: np.ndarray, ends: np.ndarray, vocab: Vocabulary
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(end, size, piece) of all pieces that match in the cuts' bytes, by end, then size."""
    sums = prefix_sums(data)
    place = np.flatnonzero(CHAR_SIZE[data] > 0)
    chars, limit = place, ends[cut[place]]
    at_end = np.zeros((len(data) + 1, vocab.longest + 1), np.int32)
    single = np.zeros(len(data), bool)
    for k in range(1, vocab.longest + 1):
        keep = place + k <= limit
        place, limit = place[keep], limit[keep]
        if not len(place):
            break
        hashes = span_hashes(sums, place, place + k)
        at = vocab.find(hashes)
        keep = at >= 0
        place, limit = place[keep], limit[keep]
        piece = vocab.piece_of[at[keep]]
        whole = place[piece >= 0]
        at_end[whole + k, k] = piece[piece >= 0] + 1
        single[whole[CHAR_SIZE[data[whole]] == k]] = True
    lone = chars[~single[chars]]
    inside = ragged(lone, CHAR_SIZE[data[lone]])
    at_end[inside + 1, 1] = vocab.byte_piece[data[inside]] + 1
    end, size = np.nonzero(at_end)
    return end, size, at_end[end, size] - 1


def build_lattice(data: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, vocab: Vocabulary) -> Lattice:
    """Forward filtering over all cuts, which stand one after another in ``data``."""
    ends = np.cumsum(sizes)
    cut = np.repeat(np.arange(len(sizes)), sizes)
    end, size, piece = edges_of(data, cut, ends, vocab)
    owner = cut[end - 1]
    depth = end - (ends - sizes)[owner]
    # stable, so edges stay together by node and in order of size
    order = np.argsort(depth.astype(np.uint16) if depth.max() < 1 << 16 else depth, kind="stable")
    depth, piece = depth[order], piece[order]
    target = (end + owner)[order]  # a cut of n bytes has n + 1 nodes
    source = target - size[order]
    weight = vocab.weight[piece]
    reach = np.full(len(data) + len(sizes), -np.inf)
    reach[ends - sizes + np.arange(len(sizes))] = 0
    first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
    count = np.diff(np.append(first, len(target)))
    node = target[first]
    score = np.empty(len(piece))
    levels = np.flatnonzero(np.concatenate([[True], np.diff(depth[first]) != 0, [True]]))
    edge_of = np.append(first, len(target))
    for a, b in zip(levels[:-1].tolist(), levels[1:].tolist(), strict=True):
        low, high = int(edge_of[a]), int(edge_of[b])
        value = reach[source[low:high]] + weight[low:high]
        begin = first[a:b] - low
        most = np.maximum.reduceat(value, begin)
        share = np.exp(value - np.repeat(most, count[a:b]))
        whole = np.add.reduceat(share, begin)
        reach[node[a:b]] = most + np.log(whole)
        score[low:high] = share / np.repeat(whole, count[a:b])
    parts = np.maximum(1, (score * (1 << BITS)).astype(np.int64)).astype(np.uint64)
    upto = np.cumsum(parts, dtype=np.uint64)
    within = upto - np.repeat(upto[first] - parts[first], count)
    begin, total = np.zeros(len(reach), np.int64), np.zeros(len(reach), np.uint64)
    begin[node] = first
    total[node] = np.add.reduceat(parts, first)
    low = ends - sizes + np.arange(len(sizes))
    return Lattice(hashes, low, low + sizes, begin, total, source, piece, within)


def draws(seeds: np.ndarray, step: int) -> np.ndarray:
    """32 random bits for each seed and step."""
    return mix(seeds + np.uint64((step + 1) * 0xD1342543DE82EF95 & (2**64 - 1))) >> np.uint64(32)


def sample(lattice: Lattice, low: np.ndarray, high: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backward sampling from node ``high`` to node ``low`` of each occurrence: pieces and how many each has."""
    live, node = np.arange(len(low)), high.copy()
    counts = np.zeros(len(low), np.int64)
    steps = []
    while len(live):
        draw = draws(seeds[live], len(steps)) * lattice.total[node] >> np.uint64(32)
        edge = lattice.first[node]
        short = np.flatnonzero(lattice.upto[edge] <= draw)
        while len(short):
            edge[short] += 1
            short = short[lattice.upto[edge[short]] <= draw[short]]
        steps.append((live, lattice.piece[edge]))
        counts[live] += 1
        node = lattice.source[edge]
        on = node != low[live]
        live, node = live[on], node[on]
    last = np.cumsum(counts)
    pieces = np.empty(last[-1] if len(last) else 0, np.int32)
    for step, (who, piece) in enumerate(steps):
        pieces[last[who] - 1 - step] = piece
    return pieces, counts


_KEPT: dict[int, Lattice] = {}


def lattice_of(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, vocab: Vocabulary
) -> Lattice:
    """The lattices of the cuts, from those that this worker keeps and new ones."""
    kept = _KEPT.get(id(vocab))
    new = np.arange(len(hashes))
    if kept is not None:
        at = np.searchsorted(kept.hashes, hashes)
        at[at == len(kept.hashes)] = 0
        new = np.flatnonzero(kept.hashes[at] != hashes)
        if not len(new):
            return kept
    sizes = (ends - starts)[new]
    built = build_lattice(data[ragged(starts[new], sizes)], sizes, hashes[new], vocab)
    whole = built if kept is None else kept.merged(built)
    if len(whole.source) <= KEPT_EDGES:
        _KEPT[id(vocab)] = whole
    return whole


def encode_cuts(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray, vocab: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of the cuts, one after another, and how many each has."""
    sums = prefix_sums(data[starts[0] : ends[-1]])
    hashes = span_hashes(sums, starts - starts[0], ends - starts[0])
    order = np.argsort(hashes, kind="stable")
    new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
    kind = np.cumsum(new) - 1
    example, sorted_hashes = order[new], hashes[order][new]
    lattice = lattice_of(data, starts[example], ends[example], sorted_hashes, vocab)
    cut = np.searchsorted(lattice.hashes, sorted_hashes)
    # equal cuts side by side, so their lattice stays in cache
    pieces, counts = sample(lattice, lattice.low[cut][kind], lattice.high[cut][kind], seeds[order])
    place, count = np.empty_like(counts), np.empty_like(counts)
    place[order] = np.cumsum(counts) - counts
    count[order] = counts
    return pieces[ragged(place, count)], count


def window_bounds(data: np.ndarray, window: int) -> list[int]:
    """Ends of windows of about ``window`` bytes, at which characters begin, from 0 to the end of the data."""
    bounds = [0]
    while len(data) - bounds[-1] > window:
        end = bounds[-1] + window
        while end < len(data) and not CHAR_SIZE[data[end]]:
            end += 1
        bounds.append(end)
    return [*bounds, len(data)] if bounds[-1] < len(data) else bounds


def window_edges(
    data: np.ndarray, low: int, high: int, vocab: Vocabulary
) -> tuple[list[int], list[int], list[int], list[float]]:
    """Edges that end in the window: bounds by their end, sizes, pieces and weights."""
    begin = max(0, low - vocab.longest)
    part = data[begin:high]
    end, size, piece = edges_of(part, np.zeros(len(part), np.int64), np.array([len(part)]), vocab)
    some = slice(int(np.searchsorted(end, low - begin, side="right")), None)
    bounds = np.searchsorted(end[some], np.arange(low - begin + 1, high - begin + 2))
    return bounds.tolist(), size[some].tolist(), piece[some].tolist(), vocab.weight[piece[some]].tolist()


def filter_window(before: list[float], bounds: list[int], size: list[int], weight: list[float]) -> list[float]:
    """Log weights of the paths to the nodes ``before`` the window and to its own."""
    reach = before.copy()
    for node, (a, b) in enumerate(pairwise(bounds), start=len(before)):
        ways = [reach[node - size[e]] + weight[e] for e in range(a, b)]
        most = max(ways, default=-inf)
        reach.append(most + log(sum([exp(way - most) for way in ways])) if most > -inf else -inf)
    return reach


def encode_long_cut(data: np.ndarray, seed: np.uint64, vocab: Vocabulary, window: int) -> np.ndarray:
    """Sampled piece ids of one cut, in memory for a window's lattice and the weights between windows."""
    limits = window_bounds(data, window)
    span = vocab.longest
    states = [[-inf] * (span - 1) + [0.0]]
    for low, high in pairwise(limits):
        bounds, size, _, weight = window_edges(data, low, high, vocab)
        states.append(filter_window(states[-1], bounds, size, weight)[-span:])
    parts, node, step = [], len(data), 0
    for before, low, high in zip(states[-2::-1], limits[-2::-1], limits[:0:-1], strict=True):
        bounds, size, piece, weight = window_edges(data, low, high, vocab)
        reach = filter_window(before, bounds, size, weight)
        steps = np.arange(step + 1, step + 1 + high - low, dtype=np.uint64)
        draw = ((mix(seed + steps * np.uint64(0xD1342543DE82EF95)) >> np.uint64(32)) / 2.0**32).tolist()
        taken = []
        while node > low:
            here = span + node - low - 1
            rest, chosen = draw[len(taken)], -1
            for e in range(bounds[node - low - 1], bounds[node - low]):
                share = exp(reach[here - size[e]] + weight[e] - reach[here])
                if share > 0:  # the last of them where rounding leaves a rest
                    chosen, rest = e, rest - share
                    if rest < 0:
                        break
            taken.append(piece[chosen])
            node -= size[chosen]
        step += len(taken)
        parts.append(np.array(taken[::-1], np.int32))
    return np.concatenate(parts[::-1])


def encode_texts(
    data: np.ndarray, bounds: np.ndarray, keys: np.ndarray, vocab: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of all texts, one after another, and the bounds of each text's ids.

    Cuts are independent and long ones filtered in windows, so lattices take no more memory than a block.
    """
    data, bounds = with_leading_space(data, bounds)
    starts = cut_starts(data, bounds, vocab)
    ends = np.append(starts[1:], len(data))
    first = np.searchsorted(starts, bounds)
    in_text = np.arange(len(starts)) - np.repeat(first[:-1], np.diff(first))
    seeds = mix(np.repeat(keys, np.diff(first)) + in_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    pieces, counts, at = [], [], 0
    long = np.append(np.flatnonzero(ends - starts > WINDOW_BYTES), len(starts))
    while at < len(starts):
        stop = int(long[np.searchsorted(long, at)])
        if stop == at:
            ids = encode_long_cut(data[starts[at] : ends[at]], seeds[at], vocab, WINDOW_BYTES)
            some, upto = (ids, np.array([len(ids)])), at + 1
        else:
            upto = max(at + 1, int(np.searchsorted(ends, starts[at] + 2 * BLOCK_BYTES, side="right")))
            upto = min(upto, stop)
            some = encode_cuts(data, starts[at:upto], ends[at:upto], seeds[at:upto], vocab)
        pieces.append(some[0])
        counts.append(some[1])
        at = upto
    limits = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    return np.concatenate(pieces), limits[first]


def decode_pieces(pieces: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a run of piece ids, and where each piece's bytes end."""
    sizes = vocab.size[pieces]
    return vocab.bytes[ragged(vocab.start[pieces], sizes)], np.cumsum(sizes)


def decode(pieces: list[int], model: str = MODEL) -> str:
    """The text of an encoded row."""
    data, _ = decode_pieces(np.array(pieces, np.int64), vocabulary(model))
    return data.tobytes().decode()[1:]


def encoder(model: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for block in text_blocks(batches, BLOCK_BYTES):
            # the text and the key come last, whatever the other columns are called
            carried, text, key = block.columns[:-2], *block.columns[-2:]
            data, bounds = joined_bytes(text)
            keys = mix(np.array(key).view(np.uint64) + np.uint64(SEED))
            ids, limits = encode_texts(data, bounds, keys, vocab)
            back, ends = decode_pieces(ids, vocab)
            ends = np.concatenate([[0], ends])[limits]
            raw, decoded, own = ids.astype("<i4").tobytes(), back.tobytes(), data.tobytes()
            n = len(limits) - 1
            digest, same = [None] * n, [False] * n
            for i in range(n):
                digest[i] = hashlib.sha256(raw[4 * limits[i] : 4 * limits[i + 1]]).hexdigest()
                same[i] = decoded[ends[i] + 1 : ends[i + 1]] == own[bounds[i] : bounds[i + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    *carried,
                    pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), pa.array(ids)),
                    pa.array(np.diff(limits)),
                    pa.array(digest, pa.string()),
                    pa.array(same),
                ],
                names=[
                    *block.schema.names[:-2],
                    "pieces", "n_pieces", "pieces_sha256", "lossless",
                ],
            )

    return encode


ENCODED = T.StructType([
    T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()),
    T.StructField("pieces_sha256", T.StringType()), T.StructField("lossless", T.BooleanType()),
])


def encode_documents(docs: DataFrame, carried: tuple[str, ...] = ("doc_id",), model: str = MODEL) -> DataFrame:
    """``carried`` columns, pieces (ids), n_pieces, pieces_sha256 (ids as little-endian 32 bits), lossless of each row.

    A carried column named like one of these four takes underscores at its end.
    """
    fields, columns = [], []
    for c in carried:
        name = c
        while name in ENCODED.names or (name != c and name in carried):
            name += "_"
        fields.append(T.StructField(name, docs.schema[c].dataType))
        columns.append(F.col(f"`{c}`").alias(name))
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00"))).alias(free_name(docs, "row_key"))
    schema = T.StructType([*fields, *ENCODED.fields])
    return docs.select(*columns, "text", key).mapInArrow(encoder(model), schema)


def op4_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to the text."""
    return encode_documents(read_table(spark, sf_dir, "documents"))
