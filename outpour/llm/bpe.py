"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

A vocabulary with ranks is compiled into a trie of tokens and a relation of neighbours: two tokens may stand side by side
if encoding their joined bytes gives them back. The encoding of a piece is the one path of tokens in which all neighbours
agree, and each prefix has exactly one. So the nondeterministic transducer is in states (tokens not yet emitted, trie
node); reading a byte moves each along the trie and adds one new state where a token ends that agrees with the token
before it. Sets of states are made deterministic when they are first met and kept with the tokens that the step emits:
those that all states have in common. A state lives no longer than the longest token, so lookahead is bounded by it.
Runs of the transducer take time linear in the piece; a memory of short pieces and of transitions has a fixed size.

Decoding joins the bytes of tokens and feeds them to an incremental UTF-8 machine, so that a character split over tokens
comes out when its last byte is there, and malformed bytes become U+FFFD.

Null texts count as empty: no tokens. Encoding is a map; a row needs nothing but itself, and repeated rows and extra
columns are of no effect. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import codecs
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from outpour.llm.store import ship

MEMORY = 3 << 17
SHORT_PIECE = 64


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of tokens in a file of lines with a token in base64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Transducer:
    """Encodes pieces of bytes. One for each Python worker; it grows as it meets new text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._beside: dict[tuple[int, int], bool] = {}
        # Trie: (node, byte) to node; the token that ends at a node, unless no encoding can give it.
        self._step: dict[tuple[int, int], int] = {}
        self._ends: list[int | None] = [None]
        for token, rank in ranks.items():
            if self._split(rank) is None and len(token) > 1:
                continue
            node = 0
            for byte in token:
                node = self._step.setdefault((node, byte), len(self._ends))
                if node == len(self._ends):
                    self._ends.append(None)
            self._ends[node] = rank
        self._forget()

    def _forget(self) -> None:
        # A set of states: tuple of (pending tokens, last token or None, trie node).
        start = (((), None, 0),)
        self._sets, self._numbers = [start], {start: 0}
        self._moves: dict[tuple[int, int], tuple[int, tuple[int, ...]]] = {}

    def _split(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for bytes and for tokens that merging never makes."""
        if rank not in self._halves:
            parts = self._merge(self.tokens[rank], rank)
            self._halves[rank] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[rank]

    def _merge(self, data: bytes, below: int) -> list[bytes]:
        """Parts of a short piece after all merges of a rank under ``below``, by the definition."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, below) for a, b in zip(parts, parts[1:])]
            least = min(found)
            if least >= below:
                break
            at = found.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def beside(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' joined bytes gives these two tokens.

        Only pairs that straddle the seam can spoil it. The parts next to the seam are followed back from the whole
        tokens to their bytes, in reverse order of merging: while a part of each side faces the seam, their union must
        not be a token that merges sooner than the later of the two is taken up into a larger part.
        """
        known = self._beside.get((left, right))
        if known is None:
            known = self._beside[left, right] = self._agree(left, right)
        return known

    def _agree(self, left: int, right: int) -> bool:
        end = len(self.ranks) + 1
        # When a part beside the seam is merged into the next larger one; the whole token never is.
        left_until, right_until = (end, 0), (end, 0)
        while True:
            until = min(left_until, right_until)
            union = self.ranks.get(self.tokens[left] + self.tokens[right])
            # Of equal ranks the leftmost pair merges first: the seam lies right of the left token's pairs
            # and left of the right token's.
            if union is not None and (union, 1) < until:
                return False
            left_made = (left, 0) if self._halves.get(left) else (-1, 0)
            right_made = (right, 2) if self._halves.get(right) else (-1, 2)
            if max(left_made, right_made)[0] < 0:
                return True
            if left_made > right_made:
                left_until, left = left_made, self._halves[left][1]
            else:
                right_until, right = right_made, self._halves[right][0]

    def _move(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        states, boundary = [], None
        for pending, last, node in self._sets[number]:
            below = self._step.get((node, byte))
            if below is None:
                continue
            states.append((pending, last, below))
            token = self._ends[below]
            if boundary is None and token is not None and (last is None or self.beside(last, token)):
                boundary = ((*pending, token), token, 0)
        if boundary is not None:
            states.append(boundary)
        if not states:
            raise ValueError("the vocabulary lacks a byte")
        shortest = min((pending for pending, _, _ in states), key=len)
        common = len(shortest)
        for pending, _, _ in states:
            while pending[:common] != shortest[:common]:
                common -= 1
        after = tuple((pending[common:], last, node) for pending, last, node in states)
        target = self._numbers.setdefault(after, len(self._sets))
        if target == len(self._sets):
            self._sets.append(after)
        move = self._moves[number, byte] = (target, shortest[:common])
        return move

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self._moves) > 4 * MEMORY:
            self._forget()
        if len(self._beside) > 4 * MEMORY:
            self._beside = {}
        ids, number, moves = [], 0, self._moves
        for byte in piece:
            number, emitted = moves.get((number, byte)) or self._move(number, byte)
            if emitted:
                ids += emitted
        for pending, _, node in self._sets[number]:
            if node == 0:
                ids += pending
        return tuple(ids)


class Encoder:
    """Encodes texts: each match of the pattern separately, no special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        # Two generations: when the young one is full it becomes the old one, so common pieces stay.
        self._young: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        pieces = self.pattern.findall(text)
        if len(self._young) > MEMORY:
            self._young, self._old = {}, self._young
        known, old = self._young, self._old
        lengthy: dict[str, tuple[int, ...]] = {}
        for piece in set(pieces).difference(known):
            ids = old.get(piece) or self.transducer.encode(piece.encode())
            (known if len(piece) <= SHORT_PIECE else lengthy)[piece] = ids
        if lengthy:
            return list(chain.from_iterable(known.get(piece) or lengthy[piece] for piece in pieces))
        return list(chain.from_iterable(map(known.__getitem__, pieces)))


@cache
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    """The encoder of this Python worker, which keeps what it has met for later tasks."""
    return Encoder(read_ranks(ranks), pattern)


class StreamDecoder:
    """Turns ids into text as they come."""

    def __init__(self, ranks: dict[bytes, int]):
        self._tokens = {rank: token for token, rank in ranks.items()}
        self._machine = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def bytes_of(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self._tokens.__getitem__, ids))

    def feed(self, ids: Iterable[int], final: bool = False) -> str:
        """The characters that these ids complete."""
        return self._machine.decode(self.bytes_of(ids), final)


def map_encoded(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    ranks: bytes,
    pattern: str,
    finish: Callable[[list[int], StreamDecoder], tuple],
    schema: str,
) -> DataFrame:
    """id and what ``finish`` makes of the ids of each row (columns of ``schema``), in the task that encodes them.

    ``ranks``: contents of the file of ranks; it is broadcast, and no larger than the vocabulary.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(ranks)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    out = StructType([rows.schema["id"], *StructType.fromDDL(schema)])
    arrow = to_arrow_schema(out)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = read_ranks(shared.value)
        encoder, decoder = _encoder(shared.value, pattern), StreamDecoder(own)
        for part in parts:
            for start in range(0, part.num_rows, 64):  # few rows at a time: ids of long texts fill memory
                rows = part.slice(start, 64)
                made = [finish(encoder.encode(text or ""), decoder) for text in rows.column(1).to_pylist()]
                columns = [pa.array(column, arrow.field(k + 1).type) for k, column in enumerate(zip(*made))]
                yield pa.RecordBatch.from_arrays([rows.column(0), *columns], names=arrow.names)

    return rows.mapInArrow(batches, out)


def encode_texts(docs: DataFrame, id_column: str, text_column: str, ranks: bytes, pattern: str) -> DataFrame:
    """id and ids (array of int) of each row."""
    return map_encoded(docs, id_column, text_column, ranks, pattern, lambda ids, _: (ids,), "ids array<int>")


def decode_ids(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """The columns of ``encoded`` (with ids), and data (bytes) and text; null ids count as none."""
    spark = encoded.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(ranks)
    names = [name for name in encoded.columns if name not in ("data", "text")]
    rows = encoded.select(*[F.col(f"`{name}`") for name in names])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = StreamDecoder(read_ranks(shared.value))
        for part in parts:
            ids = part.column(names.index("ids")).to_pylist()
            data = pa.array([decoder.bytes_of(own or ()) for own in ids], pa.binary())
            text = pa.array([decoder.feed(own or (), final=True) for own in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, data, text], [*names, "data", "text"])

    return rows.mapInArrow(batches, StructType([*rows.schema, *StructType.fromDDL("data binary, text string")]))
