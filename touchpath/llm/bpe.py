"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A sequence of tokens is what the merges make of a text exactly when the merges make each two neighbours of their
joined bytes; so the valid sequences are the paths of a transducer that reads bytes along the vocabulary's trie and,
at the end of a token, goes on with any token that may follow it. Read from the left, each prefix has exactly one
such path. ``Transducer`` runs all paths at once: its state is the longest end of the text that begins a token (all
hypotheses about the token being read are ends of it), and its transitions are determinised when a text first asks
for them. With each byte it notes the token that ends the prefix's only path. A token is emitted once every hypothesis
still alive goes through it: the lookahead is bounded by the longest token behind the point where paths meet.
"""

from __future__ import annotations

import base64
import struct
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from touchpath.llm.common import portions, utf8

# bounds of what one encoder keeps: pieces and checked token pairs
MOST_PIECES = 100_000
MOST_PAIRS = 400_000

# bytes after which the tokens that are certain leave the memory
EMIT_EVERY = 4_096

_ROOT = 0


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks by token from the lines ``base64 rank`` of a vocabulary file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Transducer:
    """Bytes of one piece to the ids that the merges of ``ranks`` give."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._never = 1 + max(self.tokens, default=0)  # after all merges
        self._pairs: dict[int, bool] = {}
        self._borders: dict[int, tuple[list, list] | None] = {}
        # the trie of the vocabulary: node -> byte -> node, and each node's parent, byte, depth and token
        self._steps: list[dict[int, int]] = [{}]
        self._from: list[tuple[int, int]] = [(_ROOT, 0)]
        self._depth, self._ends = [0], [-1]
        for token, rank in ranks.items():
            node = _ROOT
            for byte in token:
                following = self._steps[node].get(byte)
                if following is None:
                    following = self._steps[node][byte] = len(self._ends)
                    self._steps.append({})
                    self._from.append((node, byte))
                    self._depth.append(self._depth[node] + 1)
                    self._ends.append(-1)
                node = following
            self._ends[node] = rank
        self._shorter: dict[int, int] = {}  # node -> node of its longest proper end
        self._closing: dict[int, list[tuple[int, int]]] = {}  # node -> (length, token) of its ends, longest first

    def _merge(self, data: bytes) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
        """The parts that the merges of ``data`` leave, and after each merge its rank with the outer parts then."""
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        history = []
        while len(parts) > 1:
            best, place = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, place = rank, i
            if best is None:
                break
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
            history.append((best, parts[0], parts[-1]))
        return parts, history

    def _border(self, token: int) -> tuple[list, list] | None:
        """How the first and the last part of a token grow: (rank of the merge that ends it, part), in order of rank.

        None if the merges do not make the token, or not in order of rank.
        """
        if token not in self._borders:
            data = self.tokens[token]
            parts, history = self._merge(data)
            ranks = [rank for rank, _, _ in history]
            found = None
            if parts == [data] and ranks == sorted(ranks):
                firsts, lasts = [], []
                first, last = data[:1], data[-1:]
                for rank, left, right in history:
                    if left != first:
                        firsts.append((rank, first))
                        first = left
                    if right != last:
                        lasts.append((rank, last))
                        last = right
                found = [*firsts, (self._never, first)], [*lasts, (self._never, last)]
            self._borders[token] = found
        return self._borders[token]

    def _leaves(self, last: int, token: int) -> bool:
        after = self._border(token)
        if last < 0:
            return after is not None or self._merge(self.tokens[token])[0] == [self.tokens[token]]
        before = self._border(last)
        if before is None or after is None:
            both = self.tokens[last], self.tokens[token]
            return self._merge(both[0] + both[1])[0] == list(both)
        # the parts at the border change at known ranks; a merge across it must not come earlier
        ends, begins, i, j = before[1], after[0], 0, 0
        while True:
            until_left, left = ends[i]
            until_right, right = begins[j]
            across = self.ranks.get(left + right)
            if across is not None and across < until_left and across <= until_right:
                return False
            if i + 1 == len(ends) and j + 1 == len(begins):
                return True
            if until_left <= until_right:
                i += 1
            else:
                j += 1

    def may_follow(self, last: int, token: int) -> bool:
        """Whether the merges leave the border between two tokens (or, with last -1, make the token at all)."""
        key = (last << 24) + token
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= MOST_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._leaves(last, token) and (last < 0 or self.may_follow(-1, token))
        return known

    def _fallback(self, node: int) -> int:
        found = self._shorter.get(node)
        if found is None:
            parent, byte = self._from[node]
            found = _ROOT if parent == _ROOT else self._go(self._fallback(parent), byte)
            self._shorter[node] = found
        return found

    def _go(self, node: int, byte: int) -> int:
        """The transition, determinised when first asked for."""
        found = self._steps[node].get(byte)
        if found is None:
            if node == _ROOT:
                raise ValueError(f"no token of the vocabulary begins with byte {byte}")
            found = self._steps[node][byte] = self._go(self._fallback(node), byte)
        return found

    def _tokens_at(self, node: int) -> list[tuple[int, int]]:
        found, at = [], node
        while at != _ROOT:
            token = self._ends[at]
            if token >= 0 and self.may_follow(-1, token):
                found.append((self._depth[at], token))
            at = self._fallback(at)
        self._closing[node] = found
        return found

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token as it stands is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        emitted: list[int] = []
        last, size = [-1], [0]  # of each prefix: the last token of its path, and that token's length
        node, steps, closing, pairs = _ROOT, self._steps, self._closing, self._pairs
        for byte in piece:
            following = steps[node].get(byte)
            node = following if following is not None else self._go(node, byte)
            here = len(last)
            tokens = closing.get(node)
            for length, token in tokens if tokens is not None else self._tokens_at(node):
                before = last[here - length]
                fits = pairs.get((before << 24) + token)
                if fits or (fits is None and self.may_follow(before, token)):
                    last.append(token)
                    size.append(length)
                    break
            else:
                raise ValueError(f"no token of the vocabulary ends with byte {byte}")
            if here >= EMIT_EVERY:
                last, size = self._emit(last, size, self._depth[node], emitted)
        return emitted + self._path(last, size, len(last) - 1)

    @staticmethod
    def _path(last: list[int], size: list[int], at: int) -> list[int]:
        found = []
        while at > 0:
            found.append(last[at])
            at -= size[at]
        found.reverse()
        return found

    def _emit(self, last: list[int], size: list[int], open_bytes: int, emitted: list[int]) -> tuple[list, list]:
        """Emit what all live hypotheses share: each begins at one of the last ``open_bytes`` places."""
        meet: set[int] | None = None
        for at in range(len(last) - 1 - open_bytes, len(last)):
            seen = set()
            while at > 0:
                seen.add(at)
                at -= size[at]
            meet = seen if meet is None else meet & seen
        certain = max(meet, default=0)
        if not certain:
            return last, size
        emitted += self._path(last, size, certain)
        return last[certain:], [0, *size[certain + 1 :]]


class Encoder:
    """Texts to ids, piece by piece; the ids of recent pieces are kept."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer, self.pieces = Transducer(ranks), regex.compile(pattern).findall
        self._kept: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _packed(self, piece: str) -> bytes:
        packed = self._older.get(piece)
        if packed is None:
            ids = self.transducer.encode(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) < 100:
            self._kept[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after the other."""
        if len(self._kept) >= MOST_PIECES:  # those met since the last time stay known
            self._kept, self._older = {}, self._kept
        known, packed = self._kept.get, self._packed
        return b"".join([known(piece) or packed(piece) for piece in self.pieces(text)])


class Utf8Stream:
    """Takes bytes in any portions and gives back whole characters, holding back what a later portion may finish.

    The state is the unfinished character (at most three bytes). Bytes that cannot become a character pass through
    at once, so that everything given back, with ``finish``, is everything taken.
    """

    def __init__(self):
        self.held = b""

    @staticmethod
    def _owed(lead: int) -> int:
        """Bytes a character has in all, by its first byte; 1 for bytes that begin none."""
        if 0xC2 <= lead <= 0xDF:
            return 2
        if 0xE0 <= lead <= 0xEF:
            return 3
        return 4 if 0xF0 <= lead <= 0xF4 else 1

    def take(self, portion: bytes) -> bytes:
        data = self.held + portion
        cut = len(data)
        for back in range(1, min(4, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 != 0x80:  # the last byte that does not continue a character
                if self._owed(byte) > back:
                    cut = len(data) - back
                break
        self.held = data[cut:]
        return data[:cut]

    def finish(self) -> bytes:
        data, self.held = self.held, b""
        return data


class Decoder:
    """Ids to bytes, in portions that end at character borders.

    The tokens lie one after the other in one array, and those of a portion are gathered from it at once.
    """

    def __init__(self, ranks: dict[bytes, int], portion: int = 16_384):
        tokens = sorted((rank, token) for token, rank in ranks.items())
        self.ids = np.array([rank for rank, _ in tokens], np.int64)
        self.sizes = np.array([len(token) for _, token in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(token for _, token in tokens), np.uint8)
        self.whole = len(tokens) == 0 or self.ids[-1] == len(tokens) - 1  # no id is left out: an id is its own place
        self.portion = portion

    def _places(self, ids: np.ndarray) -> np.ndarray:
        places = ids if self.whole else np.searchsorted(self.ids, ids)
        unknown = places >= len(self.ids)
        if not self.whole:
            unknown |= self.ids[np.where(unknown, 0, places)] != ids
        if unknown.any():
            raise KeyError(int(ids[unknown][0]))
        return places

    def _joined(self, ids: np.ndarray) -> bytes:
        places = self._places(ids)
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        shifts = np.repeat(self.starts[places] - ends + sizes, sizes)
        return self.bytes[shifts + np.arange(len(shifts))].tobytes()

    def stream(self, ids: bytes) -> Iterator[bytes]:
        machine, numbers = Utf8Stream(), np.frombuffer(ids, "<u4")
        for i in range(0, len(numbers), self.portion):
            yield machine.take(self._joined(numbers[i : i + self.portion]))
        yield machine.finish()


_encoders: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _encoder(file: Broadcast, pattern: str) -> Encoder:
    """One encoder per Python worker, for as long as its tasks use this broadcast: with other work it is let go."""
    made = _encoders.setdefault(file, {})
    if pattern not in made:
        made[pattern] = Encoder(read_ranks(file.value), pattern)
    return made[pattern]


def _vocabulary(frame: DataFrame, path: str):
    with open(path, "rb") as file:  # a vocabulary, some hundred kB, whatever the corpus
        return frame.sparkSession.sparkContext.broadcast(file.read())


def encode(documents: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, token_ids`` of each text; token_ids are little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a rank file on the driver, ``pattern`` what parts a text before the merges. A null
    text is empty and has no tokens. Rows are encoded one by one: repeated rows stay, null ids stay, an empty table
    gives an empty table, other columns are left out. There is no shuffle.
    """
    file = _vocabulary(documents, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file, pattern)
        for batch in portions(batches):
            ids = [encoder.encode(text or "") for text in batch.column(1).to_pylist()]
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "token_ids"]
            )

    chosen = documents.select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, token_ids binary")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` (as ``encode`` gives it) with the column ``decoded``: the bytes of the tokens.

    Null ids decode to nothing. Ids that are not in the vocabulary raise an error.
    """
    file = _vocabulary(encoded, vocabulary)
    columns = ["doc_id", "n_tokens", "token_ids"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(file.value))
        for batch in portions(batches):
            texts = [b"".join(decoder.stream(ids)) for ids in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*columns, "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select(*columns).mapInArrow(
        work, f"doc_id {kind}, n_tokens bigint, token_ids binary, decoded binary"
    )
