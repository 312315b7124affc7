"""Byte-level BPE encoding and decoding.

Texts are cut without a regular expression. Every code point gets a symbol that holds its
class and what the next two code points say of it; each symbol is a transition function of
a small automaton. These functions form a finite monoid, so a prefix scan with its
multiplication table gives the state before every code point, and with it whether a piece
begins there. Pieces are merged by rank behind a bounded cache. Token offsets are kept and
place each token's bytes when decoding.

A missing text is an empty one, an empty text has no tokens; texts of any length and
repeated rows need nothing special, and only the named columns of the input are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspan.llm.frames import lists, releasing, slices

#: Pieces kept with their tokens in a task; beyond it the cache starts afresh.
CACHE_PIECES = 1 << 17
#: Pieces of more bytes are merged with a heap.
LONG_PIECE = 128
#: Fewer new pieces than this are merged one by one.
FEW = 50

#: The code points with the White_Space property.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
#: What an apostrophe is cut off with.
ENDINGS = ["s", "t", "m", "d", "re", "ve", "ll"]

LETTER, NUMBER, OTHER, SPACE = range(4)
# Symbols: a code point's class with what follows it.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_INNER, S_JOIN, S_LAST, S_STOP = range(9)
# States: what the code point before was part of.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, JOINED, ONE_MORE, TWO_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a piece begins at this code point)."""
    if symbol == S_STOP:
        return FRESH, True
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    if symbol == S_JOIN:
        return JOINED, True
    if symbol == S_LAST:
        return FRESH, True
    if symbol == S_INNER:
        return IN_SPACES, state != IN_SPACES
    if symbol in (S_LETTER, S_NUMBER):
        run = IN_LETTERS if symbol == S_LETTER else IN_NUMBERS
        return run, state not in (run, JOINED)
    if state in (IN_OTHERS, JOINED):
        return IN_OTHERS, False
    return {S_SHORT: ONE_MORE, S_LONG: TWO_MORE}.get(symbol, IN_OTHERS), True


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(products, state after each function from each state, piece begins by state and symbol).

    The functions are numbered, the symbols' own first; `products[f, g]` is f, then g.
    """
    states = range(8)
    own = [tuple(_step(s, x)[0] for s in states) for x in range(9)]
    number: dict[tuple, int] = {}
    pending = list(dict.fromkeys(own)) + [tuple(states)]
    while pending:
        f = pending.pop(0)
        if f not in number:
            number[f] = len(number)
            pending += [tuple(g[s] for s in f) for g in own]
    functions = list(number)
    products = [[number[tuple(g[s] for s in f)] for g in functions] for f in functions]
    begins = [[_step(s, x)[1] for x in range(9)] for s in states]
    symbol_function = np.array([number[f] for f in own], np.uint16)
    return np.array(products, np.uint16), np.array(functions, np.uint8), (
        np.array(begins, bool), symbol_function
    )


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    by_first = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (by_first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8
    )
    table[WHITE_SPACE] = SPACE
    return table


def _symbols(codes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    kinds = classes()[codes]
    follow = np.empty_like(kinds)
    follow[:-1], follow[-1] = kinds[1:], SPACE
    follow[stops[stops > 0] - 1] = SPACE
    out = kinds.copy()
    white = kinds == SPACE
    out[white] = S_INNER
    last = white & (follow != SPACE)
    out[last] = np.where(codes[last] == 0x20, S_JOIN, S_LAST)
    marks = np.flatnonzero(codes == 0x27)
    padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
    padded[stops] = 0
    one, two = padded[marks + 1], padded[marks + 2]
    for ending in ENDINGS:
        hit = one == ord(ending[0])
        if len(ending) == 2:
            hit &= two == ord(ending[1])
        out[marks[hit]] = S_SHORT if len(ending) == 1 else S_LONG
    out[stops] = S_STOP
    return out


def _scan(f: np.ndarray, products: np.ndarray, width: int = 64) -> np.ndarray:
    """Products of all functions up to and including each place."""
    n = len(f)
    if n <= 1:
        return f
    m = len(products)
    flat = products.ravel()
    rows = -(-n // width)
    identity = int(np.flatnonzero((products == np.arange(m)).all(axis=1))[0])
    block = np.full(rows * width, identity, np.uint16)
    block[:n] = f
    block = np.ascontiguousarray(block.reshape(rows, width).T)
    for j in range(1, width):
        block[j] = flat[block[j - 1].astype(np.uint32) * m + block[j]]
    if rows > 1:
        before = _scan(block[-1, :-1], products, width).astype(np.uint32) * m
        block[:, 1:] = flat[before[None, :] + block[:, 1:]]
    return block.T.reshape(-1)[:n]


def piece_starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts joined, where pieces begin in it, and where each text's part ends."""
    joined = "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    stops = np.cumsum([len(t) + 1 for t in texts]) - 1
    products, functions, (begins, symbol_function) = automaton()
    symbols = _symbols(codes, stops)
    through = _scan(symbol_function[symbols], products)
    state = np.empty(len(codes), np.uint8)
    state[0] = FRESH
    state[1:] = functions[:, FRESH][through[:-1]]
    return joined, np.flatnonzero(begins[state, symbols]), stops


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks out of a rank file: a token in base 64 and its rank on each line."""
    pairs = map(bytes.split, data.splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


_NONE = 1 << 62


def pair_table(ranks: dict[bytes, int]) -> dict[int, int]:
    """The token that two neighbouring tokens merge to, by both their ids in one number."""
    table = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                table[a << 32 | b] = rank
    return table


def merged(piece: bytes, ranks: dict[bytes, int], pairs: dict[int, int], single: list[int]) -> list[int]:
    """Tokens of one piece: the pair of lowest rank, leftmost first, is merged until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > LONG_PIECE:
        return _merged_long(piece, ranks)
    get = pairs.get
    parts = [single[b] for b in piece]
    found = [get(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:])]
    while found and (least := min(found)) != _NONE:
        i = found.index(least)
        parts[i] = least
        del parts[i + 1], found[i]
        if i < len(found):
            found[i] = get(least << 32 | parts[i + 1], _NONE)
        if i:
            found[i - 1] = get(parts[i - 1] << 32 | least, _NONE)
    return parts


class PairTable:
    """The same table for many pairs at once: open addressing in two arrays."""

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.tokens = np.full(1 << self.bits, _NO_TOKEN, np.int64)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        tokens = np.fromiter(pairs.values(), np.int64, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            stored = self.keys[slots] == keys
            self.tokens[slots[stored]] = tokens[stored]
            keys, tokens = keys[~stored], tokens[~stored]
            slots = (slots[~stored] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        slots = self._slots(keys)
        out = np.full(len(keys), _NO_TOKEN, np.int64)
        left = np.arange(len(keys))
        while len(left):
            there = self.keys[slots]
            out[left] = np.where(there == keys, self.tokens[slots], _NO_TOKEN)
            more = (there != keys) & (there >= 0)
            left, keys = left[more], keys[more]
            slots = (slots[more] + 1) & (len(self.keys) - 1)
        return out


_NO_TOKEN = 1 << 30


def merged_many(pieces: list[bytes], table: PairTable, single: np.ndarray) -> list[np.ndarray]:
    """Tokens of many pieces at once: each round merges one pair of every piece that has one.

    Returns the tokens of all pieces one after the other and how many each piece has.
    """
    lengths = np.array([len(p) for p in pieces])
    tokens = single[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), lengths)

    def pair_tokens(at: np.ndarray) -> np.ndarray:
        """What the token at each place and the next one of its piece merge to."""
        following = np.minimum(at + 1, len(tokens) - 1)
        found = np.full(len(at), _NO_TOKEN, np.int64)
        inside = (owner[following] == owner[at]) & (following > at)
        found[inside] = table.find(tokens[at[inside]], tokens[following[inside]])
        return found

    pairs = pair_tokens(np.arange(len(tokens)))
    done_tokens, done_owners = [], []
    while len(tokens):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        best = np.minimum.reduceat(pairs << 32 | np.arange(len(pairs)), first)
        finished = best >> 32 == _NO_TOKEN
        if finished.any():
            sizes = np.diff(first, append=len(tokens))
            over = np.repeat(finished, sizes)
            done_tokens.append(tokens[over])
            done_owners.append(owner[over])
            shift = np.cumsum(over) - over
            best = best[~finished]
            best -= shift[best & 0xFFFFFFFF]
            tokens, owner, pairs = tokens[~over], owner[~over], pairs[~over]
        if not len(best):
            break
        at = best & 0xFFFFFFFF
        tokens[at] = best >> 32
        keep = np.ones(len(tokens), bool)
        keep[at + 1] = False
        tokens, owner, pairs = tokens[keep], owner[keep], pairs[keep]
        at = at - np.arange(len(at))
        before = at[at > 0] - 1
        again = np.concatenate([at, before[owner[before] == owner[before + 1]]])
        pairs[again] = pair_tokens(again)
    owners = np.concatenate(done_owners)
    order = np.argsort(owners, kind="stable")
    return [np.concatenate(done_tokens)[order], np.bincount(owners, minlength=len(pieces))]


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs over a linked list of parts."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def push(a: int) -> None:
        b = end[a]
        if b < n and (rank := ranks.get(piece[a : end[b]])) is not None:
            heapq.heappush(heap, (rank, a, end[b]))

    for a in range(n):
        push(a)
    alive = [True] * n
    while heap:
        _, a, stop = heapq.heappop(heap)
        if not alive[a] or end[a] >= n or end[end[a]] != stop or not alive[end[a]]:
            continue
        alive[end[a]] = False
        end[a] = stop
        if stop < n:
            before[stop] = a
        push(a)
        if before[a] >= 0:
            push(before[a])
    return [ranks[piece[a : end[a]]] for a in range(n) if alive[a]]


class Encoder:
    """Encodes texts, with the tokens of recent pieces kept."""

    def __init__(self, rank_file: bytes):
        self.ranks = parse_ranks(rank_file)
        self.pairs = pair_table(self.ranks)
        self.table = PairTable(self.pairs)
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.token_sizes = _vocabulary(rank_file)[2].astype(np.int32)
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.tokens, self.starts, self.lengths = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.used = 0

    def _learn(self, pieces: list[str]) -> None:
        fresh = len(self.known)
        new = list(dict.fromkeys(pieces))
        self.known.update(zip(new, range(fresh, fresh + len(new))))
        data = [p.encode() for p in new]
        short = [d for d in data if len(d) <= LONG_PIECE and d not in self.ranks]
        if len(short) < FEW:
            rows = [merged(d, self.ranks, self.pairs, self.single) for d in data]
            ids, lengths = [i for row in rows for i in row], [len(row) for row in rows]
        else:
            tokens, sizes = merged_many(short, self.table, np.array(self.single))
            cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            tokens, at, ids, lengths = tokens.tolist(), 0, [], []
            for d in data:
                if len(d) <= LONG_PIECE and d not in self.ranks:
                    own = tokens[cuts[at] : cuts[at + 1]]
                    at += 1
                else:
                    own = merged(d, self.ranks, self.pairs, self.single)
                ids += own
                lengths.append(len(own))
        end = self.used + len(ids)
        while end > len(self.tokens):
            self.tokens = np.resize(self.tokens, 2 * len(self.tokens))
        while len(self.known) > len(self.starts):
            self.starts = np.resize(self.starts, 2 * len(self.starts))
            self.lengths = np.resize(self.lengths, len(self.starts))
        self.tokens[self.used : end] = ids
        self.lengths[fresh : len(self.known)] = lengths
        self.starts[fresh : len(self.known)] = self.used + np.cumsum(lengths) - lengths
        self.used = end

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token ids, byte offset of each token in its text, number of tokens per text)."""
        joined, starts, stops = piece_starts(texts)
        bounds = starts.tolist()
        pieces = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        # A text's closing mark is a piece of its own and is left out.
        closing = np.searchsorted(starts, stops)
        inside = np.ones(len(starts), bool)
        inside[closing] = False
        pieces = list(compress(pieces, inside[:-1].tolist()))
        if len(self.known) > CACHE_PIECES:
            self.reset()
        codes = list(map(self.known.get, pieces))
        if None in codes:
            self._learn([p for p, c in zip(pieces, codes) if c is None])
            codes = list(map(self.known.get, pieces))
        code = np.array(codes, np.int64)
        lengths = self.lengths[code]
        total = int(lengths.sum())
        place = np.repeat(self.starts[code] - (np.cumsum(lengths) - lengths), lengths)
        place += np.arange(total)
        ids = self.tokens[place]
        sizes = self.token_sizes[ids].astype(np.int64)
        last = np.concatenate([[0], np.cumsum(lengths)])
        ends = last[closing - np.arange(len(closing))]
        counts = np.diff(ends, prepend=0)
        before = np.cumsum(sizes) - sizes
        first = np.concatenate([before, [int(sizes.sum())]])[ends - counts]
        return ids.astype(np.int32), (before - np.repeat(first, counts)).astype(np.int32), counts


@cache
def _encoder(rank_file: bytes) -> Encoder:
    """The worker's encoder; its tables are kept between tasks, the pieces it has learned aren't."""
    return Encoder(rank_file)


@cache
def _vocabulary(rank_file: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    by_rank = sorted((r, t) for t, r in parse_ranks(rank_file).items())
    size = by_rank[-1][0] + 1
    lengths = np.zeros(size, np.int64)
    for rank, token in by_rank:
        lengths[rank] = len(token)
    data = np.frombuffer(b"".join(t for _, t in by_rank), np.uint8)
    return data, np.cumsum(lengths) - lengths, lengths


def decoded(rank_file: bytes, ids: np.ndarray, offsets: np.ndarray) -> bytes:
    """The bytes of tokens, each put at its offset."""
    data, starts, lengths = _vocabulary(rank_file)
    size = lengths[ids]
    steps = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out = np.empty(len(steps), np.uint8)
    out[np.repeat(offsets, size) + steps] = data[np.repeat(starts[ids], size) + steps]
    return out.tobytes()


def _kept(df: DataFrame, keep: list[str]) -> list[T.StructField]:
    return [df.schema[c] for c in keep]


def encode(
    docs: DataFrame, ranks_path: str, keep: list[str] | None = None, check: bool = False
) -> DataFrame:
    """The columns `keep` with `ids` and `offsets`, both array<int>, of every whole text.

    With `check`, `round_trip` says whether they decode to the text again. The rank file,
    under a megabyte, is read by the driver and travels with the tasks.
    """
    keep = keep or ["doc_id"]
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for part, texts in slices(batch, "_text"):
                ids, offsets, counts = encoder.encode([t.decode() for t in texts])
                columns = [*part.columns[: len(keep)], lists(ids, counts), lists(offsets, counts)]
                if check:
                    ends = np.cumsum(counts).tolist()
                    columns.append(pa.array(
                        [decoded(shared.value, ids[a:b], offsets[a:b]) == text
                         for a, b, text in zip([0, *ends], ends, texts)], pa.bool_()
                    ))
                yield pa.RecordBatch.from_arrays(columns, schema.names)
        encoder.reset()

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [*_kept(docs, keep), T.StructField("ids", ints), T.StructField("offsets", ints)]
    )
    if check:
        schema = schema.add("round_trip", T.BooleanType())
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` and `ids` of what `encode` gave, with `decoded`, the bytes."""
    keep = keep or ["doc_id"]
    with open(ranks_path, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offsets = batch.column(len(keep)), batch.column(len(keep) + 1)
            cuts = ids.offsets.to_numpy()
            all_ids, all_offsets = ids.values.to_numpy(), offsets.values.to_numpy()
            out = [
                decoded(shared.value, all_ids[a:b], all_offsets[a:b])
                for a, b in zip(cuts, cuts[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep) + 1], pa.array(out, pa.binary())],
                [*keep, "ids", "decoded"],
            )

    schema = T.StructType(
        [
            *_kept(encoded, keep),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.BinaryType()),
        ]
    )
    return encoded.select(*keep, "ids", "offsets").mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, keep: list[str] | None = None) -> DataFrame:
    """Every text encoded and decoded again: token count and digests of both results.

    One pass over the texts: what `encode` and `decode` give stays in the task.
    """
    keep = keep or ["doc_id"]
    with open(ranks_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        decimal = [b"%d," % i for i in range(len(encoder.token_sizes))]
        for batch in batches:
            for part, texts in slices(batch, "_text"):
                ids, offsets, counts = encoder.encode([t.decode() for t in texts])
                ends = np.cumsum(counts).tolist()
                shown, back = [], []
                for a, b in zip([0, *ends], ends):
                    own = ids[a:b]
                    joined = b"".join(map(decimal.__getitem__, own.tolist()))
                    shown.append(hashlib.sha256(joined[:-1]).hexdigest())
                    whole = decoded(shared.value, own, offsets[a:b])
                    back.append(hashlib.sha256(whole).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array(counts, pa.int64()), pa.array(shown),
                     pa.array(back)],
                    [*keep, "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        encoder.reset()

    schema = T.StructType(
        [
            *_kept(docs, keep),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(run, schema)
