"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Words are cut without a regular expression.  Every code point has a class (letter,
number, white space, other); a few classes also look at the next characters (the last
blank before a word, an apostrophe that starts a contraction).  A class acts on the
states of a small automaton as a transition function, and all compositions of these
functions form a finite monoid.  The state before each character is therefore a
prefix product in that monoid: an associative scan, done block by block over the
whole batch of texts at once.  A boundary is a pair (state, class) that starts a word.

Each word goes through a cached pair merging.  The byte offsets of all tokens are kept
next to the ids; decoding places the token bytes by them.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe.llm.common import map_arrow, with_columns_of_text

# White_Space of Unicode.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Letters and numbers of Unicode 16.0 that Python's tables (15.1) lack, as (first, last).
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)

# Classes of characters.
OTHER, LETTER, NUMBER, BLANK, LAST_SPACE, LAST_BLANK, SHORT, LONG, RESET = range(9)
# States: nothing open, a word of letters, of numbers, of others, a space that joins what
# follows, a run of blanks, one and two letters of a contraction to come.
FREE, IN_L, IN_N, IN_O, JOIN, IN_B, ONE, TWO = range(8)
N_STATES, N_CLASSES = 8, 9
SENTINEL = 0x110000
BLOCK = 128


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a word starts at this character."""
    if kind == RESET:
        return FREE, True
    if kind == LETTER:
        if state == TWO:
            return ONE, False
        if state == ONE:
            return FREE, False
        return IN_L, state not in (IN_L, JOIN)
    if kind == NUMBER:
        return IN_N, state not in (IN_N, JOIN)
    if kind == BLANK:
        return IN_B, state != IN_B
    if kind == LAST_SPACE:
        return JOIN, True
    if kind == LAST_BLANK:
        return FREE, True
    if state in (IN_O, JOIN):
        return IN_O, False
    return {OTHER: IN_O, SHORT: ONE, LONG: TWO}[kind], True


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Element of each class, product table, state reached from each state, start flags.

    Products are composed left to right: ``product[a, b]`` first acts as ``a``, then as ``b``.
    """
    acts = [tuple(_step(s, k)[0] for s in range(N_STATES)) for k in range(N_CLASSES)]
    unit = tuple(range(N_STATES))
    known = {unit: 0}
    queue = [unit]
    for f in queue:
        for g in acts:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    product = np.array([[known[tuple(b[s] for s in a)] for b in queue] for a in queue], dtype=np.uint16)
    element = np.array([known[a] for a in acts], dtype=np.uint16)
    reached = np.array(queue, dtype=np.uint8)
    starts = np.array([[_step(s, k)[1] for k in range(N_CLASSES)] for s in range(N_STATES)])
    return element, product, reached, starts


@cache
def class_table() -> np.ndarray:
    """Class of every code point; one more entry for the sentinel between texts."""
    out = np.full(SENTINEL + 1, OTHER, dtype=np.uint8)
    for code in range(SENTINEL):
        group = unicodedata.category(chr(code))[0]
        if group == "L":
            out[code] = LETTER
        elif group == "N":
            out[code] = NUMBER
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER)):
        for first, last in ranges:
            out[first:last + 1] = kind
    out[list(WHITE)] = BLANK
    out[SENTINEL] = RESET
    return out


def _classes(codes: np.ndarray) -> np.ndarray:
    """Class of each character, with the look at its next characters."""
    kinds = class_table()[codes]
    after = np.full(len(codes), RESET, dtype=np.uint8)
    after[:-1] = kinds[1:]
    last = (kinds == BLANK) & (after != BLANK) & (after != RESET)
    marks = np.flatnonzero(codes == ord("'"))
    out = kinds.copy()
    out[last] = np.where(codes[last] == 0x20, LAST_SPACE, LAST_BLANK)
    if len(marks):
        padded = np.concatenate([codes, [SENTINEL, SENTINEL]])
        one, two = padded[marks + 1], padded[marks + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(marks), dtype=bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        out[marks[short]] = SHORT
        out[marks[long]] = LONG
    return out


def word_starts(codes: np.ndarray) -> np.ndarray:
    """Flag of each character at which a word starts; sentinels (code 0x110000) divide the texts."""
    element, product, reached, starts = _monoid()
    n = len(codes)
    if not n:
        return np.zeros(0, dtype=bool)
    kinds = _classes(codes)
    width = -(-n // BLOCK)
    # Column j of the grid holds character j of every block.
    grid = np.zeros(width * BLOCK, dtype=np.uint16)
    grid[:n] = element[kinds]
    grid = np.ascontiguousarray(grid.reshape(width, BLOCK).T)
    flat, size = product.ravel(), np.uint32(len(product))
    before = np.empty_like(grid)
    acc = np.zeros(width, dtype=np.uint16)
    for j in range(BLOCK):
        before[j] = acc
        acc = flat[acc.astype(np.uint32) * size + grid[j]]
    # Scan of the block products: each round composes with the product of twice as many blocks.
    step = 1
    while step < width:
        acc[step:] = flat[acc[:-step].astype(np.uint32) * size + acc[step:]]
        step *= 2
    at_block = np.full(width, FREE, dtype=np.uint8)
    at_block[1:] = reached[acc[:-1], FREE]
    states = reached[before, at_block[None, :]].T.reshape(-1)[:n]
    return starts[states, kinds]


def _merge_short(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """Pair merging with a list of the pairs' ranks; for words of a few bytes."""
    none, get = len(ranks) << 1, ranks.get
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        i = pairs.index(best)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return parts


def _merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """The same merges with a heap and a linked list: n log n for words of any length."""
    n = len(parts)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = right[i]
        if j < n:
            rank = ranks.get(parts[i] + parts[j])
            if rank is not None:
                heapq.heappush(heap, (rank, i, len(parts[i]), len(parts[j])))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if not parts[i] or j >= n or len(parts[i]) != a or len(parts[j]) != b:
            continue
        parts[i] += parts[j]
        parts[j] = b""
        right[i] = right[j]
        if right[j] < n:
            left[right[j]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    return [p for p in parts if p]


class Words(dict):
    """Packed ids of words already merged; emptied when it holds ``limit`` words."""

    def __init__(self, ranks: dict[bytes, int], limit: int):
        super().__init__()
        self.ranks, self.limit = ranks, limit

    def __missing__(self, word: str) -> bytes:
        data = word.encode("utf-8")
        whole = self.ranks.get(data)
        if whole is None:
            parts = [data[i:i + 1] for i in range(len(data))]
            merge = _merge_short if len(parts) <= 48 else _merge_long
            packed = np.array([self.ranks[p] for p in merge(parts, self.ranks)], dtype="<u4").tobytes()
        else:
            packed = whole.to_bytes(4, "little")
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[word] = packed
        return packed


class Encoder:
    """Ranks of a tokenizer file with a bounded cache of merged words."""

    def __init__(self, rank_file: bytes, cache_words: int = 250_000):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.words = Words(self.ranks, cache_words)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            tokens[i] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (unsigned 32-bit) of each text."""
        if not texts:
            return []
        codes = np.concatenate([
            part for t in texts for part in (np.frombuffer((t or "").encode("utf-32-le"), dtype=np.uint32), _END)
        ])
        at = np.flatnonzero(word_starts(codes))
        # A sentinel starts a word of its own, so each text's cuts end with its sentinel.
        ends = np.flatnonzero(codes[at] == SENTINEL)
        out, begin, offset, ids_of = [], 0, 0, self.words.__getitem__
        for t, end in zip(texts, ends.tolist(), strict=True):
            cuts = (at[begin:end + 1] - offset).tolist()
            packed = b"".join([ids_of(t[a:b]) for a, b in zip(cuts, cuts[1:])]) if t else b""
            out.append(np.frombuffer(packed, dtype="<u4"))
            begin, offset = end + 1, offset + len(t or "") + 1
        return out

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte at which each token starts in the UTF-8 text, and the end of the last one."""
        out = np.zeros(len(ids) + 1, dtype="<u4")
        np.cumsum(self.lengths[ids], out=out[1:])
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """Bytes of the tokens, each placed at its offset."""
        if not len(ids):
            return b""
        starts = offsets[:-1].astype(np.int64)
        spread = np.arange(int(offsets[-1]), dtype=np.int64)
        spread += np.repeat(self.places[ids] - starts, self.lengths[ids])
        return self.blob[spread].tobytes()


_END = np.array([SENTINEL], dtype=np.uint32)


@cache
def encoder(rank_path: str) -> Encoder:
    """One encoder in each Python worker.  The file is part of an installed package or at an Arrow URI."""
    fs, path = pa.fs.FileSystem.from_uri(rank_path) if "://" in rank_path else (pa.fs.LocalFileSystem(), rank_path)
    with fs.open_input_stream(path) as file:
        return Encoder(file.read())


def encode(df: DataFrame, rank_path: str, column: str = "text", check: bool = False, keep: bool = True) -> DataFrame:
    """All columns of ``df``, ``token_ids`` and ``token_offsets`` of the whole text.

    Both are packed little-endian unsigned 32-bit integers: the ids, and the byte offset
    of each token in the UTF-8 text followed by the total length (``unpack`` makes arrays
    of them).  A missing or empty text has no ids and the one offset 0.  Input columns
    called like the new ones are replaced.  ``check`` adds ``decoded``, the bytes that the
    packed columns give when they are decoded again, without a second pass through Python.
    Without ``keep`` the text is left out.
    """
    def make():
        enc = encoder(rank_path)

        def run(texts):
            ids = enc.encode(texts)
            offsets = [enc.offsets(x) for x in ids]
            out = [pa.array([x.tobytes() for x in column], pa.binary()) for column in (ids, offsets)]
            if check:
                out.append(pa.array([enc.decode(i, o) for i, o in zip(ids, offsets)], pa.binary()))
            return out

        return run

    new = ("token_ids", "token_offsets", *(["decoded"] if check else []))
    return with_columns_of_text(df, column, make, [T.StructField(c, T.BinaryType()) for c in new], keep)


def decode(df: DataFrame, rank_path: str) -> DataFrame:
    """All columns of an encoded table and ``decoded``, the bytes of its tokens."""
    df = df.drop("decoded")
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())])
    names = schema.names

    def run(batches):
        enc = encoder(rank_path)
        for batch in batches:
            ids, offsets = (batch.column(batch.schema.get_field_index(c)) for c in ("token_ids", "token_offsets"))
            done = [
                enc.decode(np.frombuffer(i.as_buffer(), dtype="<u4"), np.frombuffer(o.as_buffer(), dtype="<u4"))
                if i.is_valid and o.is_valid else None
                for i, o in zip(ids, offsets)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.binary())], names=names)

    return map_arrow(df, run, schema)


def unpack(packed):
    """Array of integers from packed little-endian unsigned 32-bit integers."""
    return F.transform(
        F.regexp_extract_all(F.hex(packed), F.lit("([0-9A-F]{8})"), F.lit(1)),
        lambda h: F.conv(F.concat(*[F.substring(h, k, 2) for k in (7, 5, 3, 1)]), 16, 10).cast("long"),
    )


def digests(df: DataFrame, rank_path: str) -> DataFrame:
    """Number of tokens and SHA-256 of ids and decoded bytes per document."""
    done = encode(df.select("doc_id", "text"), rank_path, check=True, keep=False)
    return done.select(
        "doc_id",
        (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
