"""Byte-level BPE as a lazily determinised finite-state transducer, and a
streaming decoder.

Encoding.  A token sequence is the encoding of its bytes exactly when every
adjacent pair of its tokens is (two merges that never cross the pair's border
cannot cross it in a longer text), so the ranks define a nondeterministic
transducer: read bytes down the trie of tokens, and at a token's end either go
on or emit it, if it agrees with the token before.  Every prefix has one
encoding, so after any byte the nondeterministic state is one path for each
place where the unfinished token may have begun.  The transducer is
determinised by the subset construction, each transition when a text first
takes it: a deterministic state is the set of (tokens held back, last token,
trie node), and the tokens on which all its paths agree are emitted at once.
What is held back is the lookahead; it is bounded by the vocabulary, not by the
text, so a piece of any length takes time in proportion to its bytes.

Decoding.  Token bytes run through an incremental UTF-8 state machine whose
state is the unfinished character; its steps per (state, token) are
remembered, so text comes out token by token without looking back.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Vocabulary of a public byte-level BPE: lines of "base64 rank".
RANKS = "byte_bpe_50k.tiktoken"
# Bounds on what a worker remembers (all of it can be built again): transducer
# transitions, token pairs, encodings of short pieces, decoder steps.
MOST_STEPS = 500_000
MOST_PAIRS = 300_000
MOST_PIECES = 200_000
#: Documents that a worker hands back at a time.
ROWS_OUT = 500
PIECE_CHARS = 48
MEMBERS = -1
REPLACEMENT = "�"


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of "base64 rank"."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines.splitlines() if line)}


def merged(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Byte-pair encoding by its definition: join the adjacent pair of lowest
    rank, leftmost first, until no pair is a token.  Quadratic; used on single
    tokens and token pairs only."""
    none, get = len(ranks) + 256, ranks.get
    parts = [data[i : i + 1] for i in range(len(data))]
    cost = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
    while cost and (low := min(cost)) < none:
        i = cost.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del cost[i]
        if i < len(cost):
            cost[i] = get(parts[i] + parts[i + 1], none)
        if i:
            cost[i - 1] = get(parts[i - 1] + parts[i], none)
    return parts


class Transducer:
    """The transducer of one vocabulary.  Its tables grow as texts need them
    and start afresh at their bounds."""

    ROOT = 0
    NONE = -1

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the single bytes {missing[:5]}")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}  # 256 * trie node + byte -> trie node
        self.token = [self.NONE]  # of each trie node
        self.inner = [False]  # whether a trie node has children
        for token, rank in ranks.items():
            node = self.ROOT
            for byte in token:
                below = self.child.get(256 * node + byte)
                if below is None:
                    below = self.child[256 * node + byte] = len(self.token)
                    self.token.append(self.NONE)
                    self.inner.append(False)
                    self.inner[node] = True
                node = below
            self.token[node] = rank
        self.pieces = Pieces(self.encode_piece)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states: dict[tuple, dict] = {}
        self._forget()

    def _forget(self) -> None:
        for state in self.states.values():
            state.clear()  # states refer to each other
        self.states.clear()
        self.n_steps = 0
        self.start = self._state((((), self.NONE, self.ROOT),))

    def _state(self, members: tuple) -> dict:
        """The deterministic state of these paths: its steps so far, byte ->
        (next state, output), and under MEMBERS the paths."""
        state = self.states.get(members)
        if state is None:
            state = self.states[members] = {MEMBERS: members}
        return state

    def agree(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (NONE: begin a piece)."""
        key = (before, token)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            own = [self.bytes_of[token]]
            if before != self.NONE:
                own.insert(0, self.bytes_of[before])
            known = self.pairs[key] = merged(b"".join(own), self.ranks) == own
        return known

    def _advance(self, state: dict, byte: int) -> tuple[dict, tuple[int, ...]]:
        """The deterministic transition, made from the member paths."""
        members = state[MEMBERS]
        if self.n_steps >= MOST_STEPS:
            self._forget()
            state = self._state(members)
        child, inner, tokens = self.child, self.inner, self.token
        paths, ended = [], None
        for held, last, node in members:
            below = child.get(256 * node + byte)
            if below is None:
                continue
            if inner[below]:
                paths.append((held, last, below))
            if ended is None:
                token = tokens[below]
                if token != self.NONE and self.agree(last, token):
                    ended = ((*held, token), token, self.ROOT)
        paths.append(ended)  # every prefix has an encoding
        shared, least = 0, min([len(held) for held, _, _ in paths])
        while shared < least and len({held[shared] for held, _, _ in paths}) == 1:
            shared += 1  # the tokens that all paths begin with
        if shared:
            paths = [(held[shared:], last, node) for held, last, node in paths]
        found = state[byte] = self._state(tuple(paths)), ended[0][:shared]
        self.n_steps += 1
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece (one match of the splitting pattern)."""
        out: list[int] = []
        state = self.start
        for byte in piece:
            found = state.get(byte)
            state, emitted = found if found is not None else self._advance(state, byte)
            if emitted:
                out += emitted
        out += state[MEMBERS][-1][0]  # the path that ends on a token
        if len(out) > 1 and piece in self.ranks:
            return [self.ranks[piece]]  # a token that its own merges cannot make
        return out

    def encode(self, text: str, pieces: regex.Pattern) -> list[int]:
        """Token ids of ``text``, each match of ``pieces`` on its own."""
        return list(chain.from_iterable(map(self.pieces.__getitem__, pieces.findall(text))))


class Pieces(dict):
    """Encodings of the short pieces that came up again lately: a piece is
    kept from its second time on (its first leaves a hash), and pieces not
    seen since the dictionary was last full make room."""

    def __init__(self, encode_piece: Callable[[bytes], list[int]]):
        self.encode_piece = encode_piece
        self.older: dict[str, tuple[int, ...]] = {}
        self.once = bytearray(1 << 20)
        self.n_once = 0

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode_piece(piece.encode())
            if len(piece) > PIECE_CHARS:
                return ids
            mark = hash(piece) & 0xFFFFF
            if not self.once[mark]:
                if self.n_once > MOST_PIECES:
                    self.once, self.n_once = bytearray(1 << 20), 0
                self.once[mark] = 1
                self.n_once += 1
                return ids
            ids = tuple(ids)
        if 2 * len(self) >= MOST_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


@contextmanager
def no_collection() -> Iterator[None]:
    """Python's cycle collector off: the tables hold many small objects, none
    of them garbage, which it would walk again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Utf8Machine:
    """Incremental UTF-8: feed bytes, get the characters they complete.

    The state is (bytes of the unfinished character, how many more it needs,
    least and greatest next byte).  A byte that cannot continue closes the
    unfinished character with REPLACEMENT and is read again as a first byte.
    """

    # First byte -> (bytes to come, least and greatest second byte).
    FIRST = {
        **{b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)},
        **{b: (2, 0xA0 if b == 0xE0 else 0x80, 0x9F if b == 0xED else 0xBF) for b in range(0xE0, 0xF0)},
        **{b: (3, 0x90 if b == 0xF0 else 0x80, 0x8F if b == 0xF4 else 0xBF) for b in range(0xF0, 0xF5)},
    }
    START = (b"", 0, 0, 0)

    def feed(self, state: tuple, data: bytes) -> tuple[tuple, str]:
        """(next state, completed characters)."""
        held, more, least, most = state
        out = []
        for byte in data:
            if more and least <= byte <= most:
                held += bytes([byte])
                more, least, most = more - 1, 0x80, 0xBF
                if not more:
                    out.append(held.decode())
                    held = b""
                continue
            if more:
                out.append(REPLACEMENT)
            held, more = b"", 0
            if byte < 0x80:
                out.append(chr(byte))
            elif byte in self.FIRST:
                more, least, most = self.FIRST[byte]
                held = bytes([byte])
            else:
                out.append(REPLACEMENT)
        return ((held, more, least, most) if more else self.START), "".join(out)

    def finish(self, state: tuple) -> str:
        """What an unfinished character at the end of the stream becomes."""
        return REPLACEMENT if state[1] else ""


class Decoder:
    """Streaming decoder of token ids."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.machine = Utf8Machine()
        # Unfinished character -> token id -> (the next one's steps, text, next one).
        self.steps: dict[tuple, dict[int, tuple[dict, str, tuple]]] = {}
        self.n_steps = 0

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text in parts: after each id, the characters it completes (maybe
        none); at the end, the mark of an unfinished one.  An unknown id is an
        error."""
        state = self.machine.START
        own = self.steps.setdefault(state, {})
        for i in ids:
            found = own.get(i)
            if found is None:
                if self.n_steps >= MOST_STEPS:
                    self.steps, self.n_steps = {}, 0
                    own = self.steps.setdefault(state, {})
                after, text = self.machine.feed(state, self.bytes_of[i])
                found = own[i] = self.steps.setdefault(after, {}), text, after
                self.n_steps += 1
            own, text, state = found
            yield text
        yield self.machine.finish(state)

    def decode(self, ids: Iterable[int]) -> str:
        return "".join(self.stream(ids))


def vocabulary(spark: SparkSession, ranks_path: str | None = None, pattern: str | None = None) -> Broadcast:
    """The vocabulary (about a megabyte, whatever the documents) on every
    executor.  ``ranks_path``: a rank file that the driver can open; by default
    RANKS among the public tokenizers, with their splitting pattern."""
    with open(ranks_path or public_tokenizers.path(RANKS), "rb") as f:
        return spark.sparkContext.broadcast({"lines": f.read(), "pattern": pattern or public_tokenizers.PATTERN})


def machines(shared: Broadcast) -> tuple[Transducer, Decoder, regex.Pattern]:
    """The machines of a vocabulary.  A worker keeps them beside its copy of
    the rank file, so it builds them once, however many tasks it runs."""
    known = shared.value
    if "machines" not in known:
        transducer = Transducer(read_ranks(known["lines"]))
        known["machines"] = transducer, Decoder(transducer.bytes_of), regex.compile(known["pattern"])
    return known["machines"]


def encode(text: Column, shared: Broadcast) -> Column:
    """Token ids (array<int>) of each whole text; null and empty texts: none.
    No special tokens: their strings are ordinary text."""

    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        transducer, _, pieces = machines(shared)
        for texts in parts:
            with no_collection():
                out = [transducer.encode(t, pieces) if t else [] for t in texts]
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(ids, "array<int>")(text.cast("string"))


def decode(ids: Column, shared: Broadcast) -> Column:
    """The text of each array of token ids (null: null; no ids: empty).  Bytes
    that are not UTF-8 become U+FFFD; an id outside the vocabulary fails."""

    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, decoder, _ = machines(shared)
        for rows in parts:
            yield pd.Series([None if r is None else decoder.decode(r.tolist()) for r in rows], dtype=object)

    return F.pandas_udf(texts, "string")(ids)


def encode_documents(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(row, ids, decoded), one row per document: its token ids and the text
    that they decode to, made in one pass (one Python worker a task).

    Null and empty texts have no ids and decode to the empty string; repeated
    rows are encoded one by one; an empty table gives no rows; the columns of
    ``docs`` stay inside ``row``, so none can clash.  Nothing is shuffled.
    """
    shared = vocabulary(docs.sparkSession, ranks_path, pattern)

    def coded(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        transducer, decoder, pieces = machines(shared)
        for batch in parts:
            for first in range(0, len(batch), ROWS_OUT):
                ids, ends, decoded = array("i"), [0], []
                with no_collection():
                    for text in batch.slice(first, ROWS_OUT).to_pylist():
                        own = transducer.encode(text, pieces) if text else []
                        ids.extend(own)
                        ends.append(len(ids))
                        decoded.append(decoder.decode(own))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), len(ids), [None, pa.py_buffer(ids)]))
                yield pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], ["ids", "decoded"])

    both = F.arrow_udf(coded, "ids array<int>, decoded string")(F.col("text").cast("string"))
    return docs.select(F.struct("*").alias("row"), both.alias("both")).select("row", "both.ids", "both.decoded")
