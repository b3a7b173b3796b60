"""Byte-level BPE: encoding with vectorised pre-tokenisation, and decoding.

Texts of a slice become one array of code points. Each code point gets a symbol from a table of
classes (letters, numbers, white space as the tokenizer library classes them) and from its
neighbour: the last blank before other text, and letters that can end a contraction, are symbols of
their own. An automaton over these symbols knows which piece is open; since functions on its states
compose associatively, the states of all positions come from a scan: every symbol is the number of
a transition function, and a table gives the number of the composition of two functions. Blocks are
scanned side by side, then the block totals, then all positions are looked up. A table on (state,
symbol) tells where a piece begins. No regular expression is involved.

Pieces go through a bounded table of merged pieces; an unknown piece is merged pair by pair, lowest
rank first, with a heap for long ones. Ids are joined over the offsets of the pieces; decoding
concatenates the bytes of the ids.

Defined cases: NULL and empty texts have no ids (empty id list, hash of nothing); any code points,
also unassigned ones, are encoded; equal rows give equal results; a NULL id is kept; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from milepost.llm.common import steps, texts_of

#: Pieces kept by a task, and the longest that is kept (in characters).
KNOWN_PIECES, KEPT_PIECE = 400_000, 40
#: Pieces of up to so many bytes are merged by looking through the list of pairs.
FEW_BYTES = 100
NEVER = 1 << 62
#: Positions that one column of the scan runs over.
BLOCK = 128

# symbols
BREAK, BLANKS, LAST_SPACE, LAST_BLANK, ONE, TWO, LETTER, NUMBER, OTHER, QUOTE = range(10)
# states: what is open after a symbol
(CLOSED, IN_BLANKS, AFTER_SPACE, AFTER_BLANK, IN_LETTERS, IN_NUMBERS, IN_OTHER, QUOTED,
 HALF) = range(9)
# classes of code points
C_OTHER, C_SPACE, C_LETTER, C_NUMBER = range(4)


def _next_state(state: int, symbol: int) -> int:
    if symbol in (ONE, TWO, LETTER):
        if state == HALF or (state == QUOTED and symbol == ONE):
            return CLOSED
        return HALF if state == QUOTED and symbol == TWO else IN_LETTERS
    if symbol == QUOTE:
        return IN_OTHER if state in (AFTER_SPACE, IN_OTHER, QUOTED) else QUOTED
    return {BREAK: CLOSED, BLANKS: IN_BLANKS, LAST_SPACE: AFTER_SPACE, LAST_BLANK: AFTER_BLANK,
            NUMBER: IN_NUMBERS, OTHER: IN_OTHER}[symbol]


def _begins(state: int, symbol: int) -> bool:
    """Whether a piece begins at the symbol."""
    if symbol == BREAK:
        return False
    if symbol == BLANKS:
        return state != IN_BLANKS
    if symbol in (LAST_SPACE, LAST_BLANK):  # splits off the run of blanks it ends
        return True
    if state == AFTER_SPACE:
        return False
    if symbol == NUMBER:
        return state != IN_NUMBERS
    if symbol in (OTHER, QUOTE):
        return state not in (IN_OTHER, QUOTED)
    if state == QUOTED:
        return symbol == LETTER
    return state not in (IN_LETTERS, HALF)


@functools.lru_cache(1)
def automaton() -> tuple[bytes, bytes]:
    """Composition table of the transition functions, and whether a piece begins by (function before, symbol).

    Functions 0-9 belong to the symbols; the others are compositions, 16 in all. The entry at
    ``16 * f + g`` is f followed by g.
    """
    functions = [tuple(_next_state(s, c) for s in range(9)) for c in range(10)]
    number = {f: k for k, f in reversed(list(enumerate(functions)))}
    table: dict[tuple[int, int], int] = {}
    while True:
        open_ = [(a, b) for a in range(len(functions)) for b in range(len(functions)) if (a, b) not in table]
        if not open_:
            break
        for a, b in open_:
            both = tuple(functions[b][s] for s in functions[a])
            if both not in number:
                number[both] = len(functions)
                functions.append(both)
            table[a, b] = number[both]
    compose = bytes(table.get((k >> 4, k & 15), 0) for k in range(256))
    begins = bytes(
        k & 15 < 10 and _begins(functions[k >> 4][CLOSED], k & 15) for k in range(16 * len(functions))
    ).ljust(256, b"\0")
    assert len(functions) <= 16
    return compose, begins


@functools.lru_cache(1)
def packed_classes() -> bytes:
    """Class of every code point as the tokenizer library's expressions see it, compressed."""
    import tiktoken

    classes = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    ranks = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((C_SPACE, r"\s+"), (C_LETTER, r"\p{L}+"), (C_NUMBER, r"\p{N}+")):
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        text = found.decode_bytes(found.encode_ordinary(every)).decode()
        classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)] = kind
    return zlib.compress(classes.tobytes())


def class_array(packed: bytes) -> np.ndarray:
    """Class of every code point."""
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def _pairs(first: np.ndarray, second: np.ndarray, table: bytes) -> np.ndarray:
    """The table's entries for pairs of numbers below 16."""
    return np.frombuffer(((first << 4) | second).tobytes().translate(table), np.uint8).reshape(second.shape)


def scan(function: np.ndarray, compose: bytes) -> np.ndarray:
    """Inclusive scan: the composition of all functions up to each position."""
    n = len(function)
    if n <= BLOCK:
        out = function.copy()
        for k in range(1, n):
            out[k] = compose[out[k - 1] << 4 | function[k]]
        return out
    rows = -(-n // BLOCK)
    padded = np.zeros(rows * BLOCK, np.uint8)
    padded[:n] = function
    block = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    for k in range(1, BLOCK):
        block[k] = _pairs(block[k - 1], block[k], compose)
    before = scan(block[-1], compose)[:-1]
    block[:, 1:] = _pairs(np.broadcast_to(before, block[:, 1:].shape), block[:, 1:], compose)
    return np.ascontiguousarray(block.T).reshape(-1)[:n]


def piece_starts(points: np.ndarray, breaks: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """True at the first code point of each piece; ``breaks`` are the places between texts."""
    compose, begins = automaton()
    kind = classes[points]
    kind[breaks] = 255
    after = np.append(kind[1:], 255).astype(np.uint8)
    follow = np.append(points[1:], 0).astype(np.uint32)
    symbol = np.array([OTHER, BLANKS, LETTER, NUMBER], np.uint8)[np.minimum(kind, 3)]
    last = (kind == C_SPACE) & (after != C_SPACE) & (after != 255)
    symbol[last] = np.where(points[last] == 32, LAST_SPACE, LAST_BLANK)
    symbol[points == 39] = QUOTE
    for letter in "stmd":
        symbol[points == ord(letter)] = ONE
    for first, second in ("re", "ve", "ll"):
        symbol[(points == ord(first)) & (follow == ord(second))] = TWO
    symbol[breaks] = BREAK
    before = np.append(np.uint8(BREAK), scan(symbol, compose)[:-1])
    return _pairs(before, symbol, begins).view(bool)


def pieces(texts: list[str], classes: np.ndarray) -> list[list[str]]:
    """The pieces of each text."""
    whole = "\x00".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.append(0, np.cumsum(sizes + 1))
    starts = np.flatnonzero(piece_starts(points, base[1:-1] - 1, classes)) if len(points) else base[:0]
    cuts = np.searchsorted(starts, base)
    out = []
    for d in range(len(texts)):
        at = starts[cuts[d] : cuts[d + 1]].tolist()
        out.append([whole[a:b] for a, b in zip(at, [*at[1:], int(base[d + 1]) - 1])])
    return out


class Merger:
    """Merges the bytes of a piece pair by pair: the lowest rank first, leftmost among equals."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = [ranks[bytes([b])] for b in range(256)]
        #: id that two adjacent ids merge to, at ``first << 32 | second``
        self.pair = {
            left << 32 | right: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None
        }

    def merge(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self._few(piece) if len(piece) <= FEW_BYTES else self._many(piece)

    def _few(self, piece: bytes) -> list[int]:
        get = self.pair.get
        ids = [self.single[b] for b in piece]
        ranks = [get(a << 32 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) != NEVER:
            k = ranks.index(least)
            del ids[k], ranks[k]
            ids[k] = least
            if k < len(ranks):
                ranks[k] = get(least << 32 | ids[k + 1], NEVER)
            if k:
                ranks[k - 1] = get(ids[k - 1] << 32 | least, NEVER)
        return ids

    def _many(self, piece: bytes) -> list[int]:
        n = len(piece)
        ids = [self.single[b] for b in piece]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(a: int) -> None:
            b = after[a]
            if b < n and (rank := self.pair.get(ids[a] << 32 | ids[b])) is not None:
                heapq.heappush(queue, (rank, a, ids[a], ids[b]))

        for a in range(n - 1):
            offer(a)
        while queue:
            rank, a, left, right = heapq.heappop(queue)
            b = after[a]
            if ids[a] != left or b >= n or ids[b] != right:
                continue  # one of the two has been merged meanwhile
            ids[a], ids[b] = rank, -1
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [x for x in ids if x >= 0]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one rank file, with a bounded table of pieces."""

    def __init__(self, path: str, classes: bytes | None = None):
        self.ranks = read_ranks(path)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.names = [str(k) for k in range(len(self.tokens))]
        self.classes = class_array(classes or packed_classes())
        self.merge = Merger(self.ranks).merge
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = pieces(texts, self.classes)
        table = self.known
        for p in set().union(*split).difference(table):
            table[p] = self.older.get(p) or self.merge(p.encode())
        out = [list(chain.from_iterable(map(table.__getitem__, parts))) for parts in split]
        if len(table) > KNOWN_PIECES:
            self.older = {p: ids for p, ids in table.items() if len(p) <= KEPT_PIECE}
            self.known = {}
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def listed(self, ids: list[int]) -> str:
        return ",".join(map(self.names.__getitem__, ids))


def _codec_batches(path: str, classes: bytes, columns):
    def run(batches):
        codec = Codec(path, classes)
        for batch in steps(batches):
            ids = codec.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **columns(codec, ids)})

    return run


def _id_columns(codec: Codec, ids: list[list[int]]) -> dict:
    return {"ids": pa.array(ids, pa.list_(pa.int32()))}


def _digest_columns(codec: Codec, ids: list[list[int]]) -> dict:
    sha = hashlib.sha256
    return {
        "n_tokens": pa.array(map(len, ids), pa.int64()),
        "ids_sha256": [sha(codec.listed(x).encode()).hexdigest() for x in ids],
        "decoded_sha256": [sha(codec.decode(x)).hexdigest() for x in ids],
    }


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every row."""
    return texts_of(docs, id_col, text_col).mapInArrow(
        _codec_batches(path, packed_classes(), _id_columns), "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text (bytes) of rows with ``ids``; a NULL list is empty."""

    def run(batches):
        codec = Codec(path, zlib.compress(b""))
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "text": pa.array([codec.decode(x or []) for x in batch.column("ids").to_pylist()], pa.binary()),
            })

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, the SHA-256 of the ids and of the bytes that they decode to, without moving ids."""
    return texts_of(docs, id_col, text_col).mapInArrow(
        _codec_batches(path, packed_classes(), _digest_columns),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
