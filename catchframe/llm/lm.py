"""Scores of a subword lattice: the probability of a text over all its segmentations.

The pieces and first weights come from an existing vocabulary file; their probabilities are
then fitted to the training words by expectation-maximisation.  A word, with a mark for its
start, is a lattice of all pieces that match in it; a forward recursion in log space sums
over all paths.  A word of the training texts is one more edge from its start to its end:
its count, less an absolute discount, gives that edge's weight, and what the discount leaves
goes to the pieces.  So all strings together have probability 1.  A document's probability
is the product over its words and one end.

Texts are cut into words once.  Each task turns its documents into blocks of bounded size
with a dictionary of their own and stores both.  Only dictionaries are shuffled by word:
counts are summed and scored once per distinct word, go back to the dictionaries, and meet
the documents of their block.  So frequent words move once per block, not once per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchframe.llm.common import id_remainder, map_arrow, stored

BLOCK_BYTES = 16 << 20
START = b" "
LOG10 = np.log(10.0)
GRID = 1 << 22


class Lattice:
    """Pieces of a vocabulary in a trie over bytes; piece 0 is none."""

    def __init__(self, pieces: dict[bytes, float]):
        self.pieces = sorted(pieces)
        self.weights = np.array([pieces[p] for p in self.pieces])
        step, piece_at = [{}], [0]
        for i, piece in enumerate(self.pieces):
            node = 0
            for b in piece:
                nxt = step[node].get(b)
                if nxt is None:
                    nxt = step[node][b] = len(step)
                    step.append({})
                    piece_at.append(0)
                node = nxt
            piece_at[node] = i + 1
        # Node 0 of the table is the dead end, node n + 1 the trie's n.
        self.table = np.zeros((len(step) + 1, 256), dtype=np.int32)
        for node, out in enumerate(step):
            for b, nxt in out.items():
                self.table[node + 1, b] = nxt + 1
        self.piece_at = np.array([0, *piece_at], dtype=np.int32)
        self.longest = max(map(len, self.pieces))

    def matches(self, grid: np.ndarray) -> np.ndarray:
        """Piece of each row, end position and length: ``out[:, e, l]`` ends before byte ``e`` and has ``l + 1`` bytes."""
        k, n = grid.shape
        out = np.zeros((k, n + 1, min(self.longest, n)), dtype=np.int32)
        nodes = np.ones((k, n), dtype=np.int32)
        for length in range(out.shape[2]):
            nodes = self.table[nodes[:, :n - length], grid[:, length:]]
            if not nodes.any():
                break
            out[:, length + 1:, length] = self.piece_at[nodes]
        return out

    def forward(self, match: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """Log of the summed weight of all segmentations of each prefix; ``logs[0]`` is minus infinity."""
        k, ends, longest = match.shape
        out = np.full((k, ends), -np.inf)
        out[:, 0] = 0.0
        for e in range(1, ends):
            m = min(e, longest)
            paths = out[:, e - m:e][:, ::-1] + logs[match[:, e, :m]]
            top = paths.max(axis=1)
            out[:, e] = top + np.log(np.exp(paths - top[:, None]).sum(axis=1))
        return out

    def backward(self, match: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """The same of each suffix."""
        k, ends, longest = match.shape
        out = np.full((k, ends), -np.inf)
        out[:, -1] = 0.0
        for s in range(ends - 2, -1, -1):
            m = min(ends - 1 - s, longest)
            at = np.arange(m)
            paths = out[:, s + 1:s + 1 + m] + logs[match[:, s + 1 + at, at]]
            top = paths.max(axis=1)
            out[:, s] = top + np.log(np.exp(paths - top[:, None]).sum(axis=1))
        return out

    def groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length as a grid of bytes, with their places in the list; grids are bounded."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(sizes, kind="stable")
        for size in np.unique(sizes).tolist():
            places = order[np.searchsorted(sizes[order], size):np.searchsorted(sizes[order], size, side="right")]
            step = max(1, GRID // ((size + 2) * self.longest))
            for i in range(0, len(places), step):
                part = places[i:i + step]
                text = b"".join(START + words[p] for p in part.tolist())
                yield np.frombuffer(text, dtype=np.uint8).reshape(len(part), size + 1), part

    def log_probability(self, words: list[bytes], logs: np.ndarray) -> np.ndarray:
        out = np.empty(len(words))
        for grid, places in self.groups(words):
            out[places] = self.forward(self.matches(grid), logs)[:, -1]
        return out

    def expected(self, words: list[bytes], times: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in words that occur ``times`` each."""
        total = np.zeros(len(self.pieces) + 1)
        for grid, places in self.groups(words):
            match = self.matches(grid)
            ahead, behind = self.forward(match, logs), self.backward(match, logs)
            for length in range(match.shape[2]):
                used = match[:, length + 1:, length]
                row, col = np.nonzero(used)
                if len(row):
                    ids = used[row, col]
                    mass = ahead[row, col] + logs[ids] + behind[row, col + length + 1] - ahead[row, -1]
                    total += np.bincount(ids, np.exp(mass) * times[places][row], minlength=len(total))
        return total


@cache
def lattice(model_path: str) -> Lattice:
    """Pieces in lower case for A-Z and all single bytes; the weight falls with a piece's rank in the file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = {bytes([b]): 1e-6 for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        data = model.id_to_piece(i).replace("▁", " ").encode("utf-8")
        if b" " not in data[1:] and data == data.lower():
            pieces[data] = 1.0 / (1.0 - model.get_score(i))
    return Lattice(pieces)


class Dictionary(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _pack(numbers: np.ndarray) -> bytes:
    """Width in bytes, then the numbers in that width."""
    top = int(numbers.max(initial=0))
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64)


BLOCKS = (
    "block long, word binary, local int, train long, doc_id long, held_out boolean, n_tokens long, ids binary, times binary"
)


def cut_blocks(docs: DataFrame) -> DataFrame:
    """Documents and dictionaries of blocks of about ``BLOCK_BYTES``, from ``doc_id``, ``text``, ``held_out``.

    A document's row has its distinct words as differences of sorted numbers, and their counts.
    """
    names = [f.split()[0] for f in BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]

    def emit(block, words, train, rows):
        listed = list(words)
        for i in range(0, len(listed), 100_000):
            part = listed[i:i + 100_000]
            n = len(part)
            cols = [[block] * n, part, np.arange(i, i + n, dtype=np.int32), train[i:i + n], *[pa.nulls(n, k) for k in kinds[4:]]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
        n = len(rows)
        cols = [pa.array([block] * n, pa.int64()), *[pa.nulls(n, k) for k in kinds[1:4]]]
        cols += [pa.array(c, k) for c, k in zip(zip(*rows), kinds[4:])]
        yield pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        words, train, rows, held, block = Dictionary(), np.zeros(1 << 16, dtype=np.int64), [], 0, first
        for batch in batches:
            for doc_id, text, out in zip(*(batch.column(i).to_pylist() for i in range(3))):
                tokens = text.encode("utf-8").lower().split() if text else []
                ids, times = np.unique(np.array([words[t] for t in tokens], dtype=np.int64), return_counts=True)
                if len(words) > len(train):
                    train = np.concatenate([train, np.zeros(max(len(train), len(words)), dtype=np.int64)])
                if not out:
                    train[ids] += times
                rows.append((doc_id, out, len(tokens) + 1, _pack(np.diff(ids, prepend=0)), _pack(times)))
                held += len(text or "") + 100
                if held >= BLOCK_BYTES:
                    yield from emit(block, words, train, rows)
                    words, train, rows, held, block = Dictionary(), np.zeros(1 << 16, dtype=np.int64), [], 0, block + 1
        if rows:
            yield from emit(block, words, train, rows)

    return map_arrow(docs.select("doc_id", "text", "held_out"), run, BLOCKS)


def fit(vocabulary: DataFrame, model_path: str, rounds: int) -> np.ndarray:
    """Natural logs of the pieces' probabilities; entry 0 is minus infinity.

    Every training word counts once: that is what the discount takes from each.  What comes
    to the driver is one number per piece of the file in each round.
    """
    model = lattice(model_path)
    logs = np.concatenate([[-np.inf], np.log(model.weights / model.weights.sum())])
    known = vocabulary.where("c > 0").select("word")
    for _ in range(rounds):
        def run(batches, logs=logs):
            total = np.zeros(len(logs))
            for batch in batches:
                for i in range(0, batch.num_rows, 50_000):
                    words = batch.slice(i, 50_000).column(0).to_pylist()
                    total += lattice(model_path).expected(words, np.ones(len(words)), logs)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["piece", "n"])

        sums = map_arrow(known, run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros(len(logs))
        counts[np.asarray(sums.column("piece"))] = np.asarray(sums.column("n"))
        smooth = counts[1:] + 0.01
        logs = np.concatenate([[-np.inf], np.log(smooth / smooth.sum())])
    return logs


def score(docs: DataFrame, model_path: str, modulus: int = 7, held: int = 2, rounds: int = 3) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of whole texts.

    Training texts are those whose id has another remainder than ``held``; a missing id is
    one of them.  A missing or blank text is one end.  Repeated rows stay.  Both scores are
    base-10 logs: of the word counts with one added, and of the lattice.
    """
    marked = docs.select("doc_id", "text", (id_remainder("doc_id", modulus) == held).alias("held_out"))
    blocks = stored(cut_blocks(marked), "word_blocks")
    entries = blocks.where("word IS NOT NULL").select("block", "local", "word", "train")
    rows = blocks.where("word IS NULL").select("block", "doc_id", "held_out", "n_tokens", "ids", "times")
    vocabulary = stored(entries.groupBy("word").agg(F.sum("train").alias("c")), "vocabulary")
    found = vocabulary.agg(
        F.sum("c").alias("n"), *[F.count_if(hit).alias(k) for k, hit in (("v", F.col("c") > 0), ("n1", F.col("c") == 1), ("n2", F.col("c") == 2))]
    ).first()
    ends = rows.where("NOT held_out").count()
    total, kinds = (found.n or 0) + ends, found.v + bool(ends)
    logs = fit(vocabulary, model_path, rounds)
    # One more than all tokens is shared out: words less the discount, ends, and the pieces' part.
    discount = found.n1 / (found.n1 + 2 * found.n2) if found.n1 else 0.5
    to_pieces, log_end = np.log((discount * found.v + 1) / (total + 1)), np.log(max(ends, 0.5) / (total + 1))

    def add_log(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 50_000):
                part = batch.slice(i, 50_000)
                spelt = lattice(model_path).log_probability(part.column(0).to_pylist(), logs)
                own = np.maximum(np.asarray(part.column(1), dtype=float) - discount, 0.0) / (total + 1)
                with np.errstate(divide="ignore"):
                    values = np.logaddexp(np.log(own), to_pieces + spelt)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values)], names=["word", "c", "log"])

    scored = map_arrow(vocabulary.select("word", "c"), add_log, "word binary, c long, log double")
    values = entries.join(scored, "word").select(F.col("block").alias("of_block"), "local", "c", "log")
    scale = np.log10(total + kinds + 1)

    def meet(documents: pa.Table, dictionary: pa.Table) -> pa.Table:
        size = dictionary.num_rows
        count, log = np.zeros(size), np.zeros(size)
        local = np.asarray(dictionary.column("local"))
        count[local], log[local] = np.asarray(dictionary.column("c")), np.asarray(dictionary.column("log"))
        base, known = np.log10(count + 1), count > 0
        out = []
        for ids, times in zip(documents.column("ids").to_pylist(), documents.column("times").to_pylist()):
            at, n = np.cumsum(_unpack(ids)), _unpack(times)
            out.append((int(n[known[at]].sum()), float(base[at] @ n), float(log[at] @ n)))
        n_known, sums, logs_of = (np.array(c) for c in zip(*out)) if out else (np.zeros(0),) * 3
        tokens = np.asarray(documents.column("n_tokens"))
        return pa.table({
            "doc_id": documents.column("doc_id"), "held_out": documents.column("held_out"), "n_tokens": documents.column("n_tokens"),
            "n_known": pa.array((n_known + bool(ends)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(tokens), total, dtype=np.int64)),
            "base_score": pa.array(sums + np.log10(ends + 1) - tokens * scale),
            "score": pa.array((logs_of + log_end) / LOG10),
        })

    return rows.groupBy("block").cogroup(values.groupBy("of_block")).applyInArrow(
        meet, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
