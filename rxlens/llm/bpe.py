"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

A *piece* is one match of the split pattern. Which token ends the encoding of a prefix is
settled by the prefix: it is the one vocabulary entry that ends there, whose start is itself
the end of an encoded prefix, and that the merges keep apart from the token before it
(``Merges.apart``). So a piece is encoded from left to right. What can still change is only
how far the next token reaches: starts from which some longer entry may still match are
*open*, and tokens that every open start and the present end have in common are final.

The transducer's state is what the future depends on: for each open start, its node in the
vocabulary's trie and the token before that start, and the token at the present end. It is
relative to the present place, so equal situations in different pieces share a state. States
and their transitions are made when first met and kept, packed, in a table that is emptied when
it holds ``MAX_STATES`` transitions. Of a piece only its packed ids are kept: the digits and
bytes of a text's ids are looked up token by token.
Each step tells the token that ends at the present place; tokens are put out by following these
back. Chains from all open starts meet after a bounded look-ahead, and what lies before their
meeting is final: a very long piece puts it out on the way, others at their end.

The vocabulary file is read once per task from ``ranks_path``, which every executor must have.

Defined results: a null or empty text has no tokens; texts with special-token strings are
ordinary text; an entry that merging cannot reach is used only for a piece equal to it.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.llm.arrow import batch_of, map_texts, plain_texts, slices

#: Transitions, and answers about neighbours, that are kept.
MAX_STATES, MAX_APART = 400_000, 200_000
MAX_PIECES = 130_000
#: Characters whose pieces are listed at once; a longer text goes piece by piece.
LISTED = 1 << 19
#: Rows of a batch that are held as lists of ids at a time.
ROWS = 512
#: Bytes of a piece after which tokens are put out before its end.
LONG = 4096
#: Ids whose bytes or digits are looked up together.
PART = 1 << 14
#: Pieces that take their steps together, and the bytes beyond which a piece goes alone.
TOGETHER, SHORT = 16_384, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a token in base64 and its rank."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


_NEVER = 1 << 62


class Merges:
    """What the merges say about two neighbouring tokens.

    While a token is being merged, the part at its right edge grows in steps; each of these
    parts (its right *spine*) lives until the rank at which the next one takes it in. The
    same holds at a left edge. Two tokens stay apart if at no time the two parts that face
    each other would have merged first.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._spines: dict[tuple[bytes, int], list[tuple[bytes, int]]] = {}

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts whose merge made ``token``; None for a byte or if merging fails."""
        if token in self._halves:
            return self._halves[token]
        parts = [token[i : i + 1] for i in range(len(token))]
        ranks = self.ranks
        while len(parts) > 2:
            best, at = _NEVER, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], _NEVER)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        found = (parts[0], parts[1]) if len(parts) == 2 and token in ranks else None
        self._halves[token] = found
        return found

    def reachable(self, token: bytes) -> bool:
        return len(token) == 1 or self.halves(token) is not None

    def spine(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """Parts at the left (0) or right (1) edge, smallest first, with the rank they end at."""
        key = (token, side)
        known = self._spines.get(key)
        if known is None:
            halves = self.halves(token)
            below = self.spine(halves[side], side) if halves else []
            if below:
                below = below[:-1] + [(below[-1][0], self.ranks[token])]
            known = self._spines[key] = below + [(token, _NEVER)]
        return known

    def apart(self, left: bytes, right: bytes) -> bool:
        """Whether merging the bytes of both gives the two tokens again."""
        a, b = self.spine(left, 1), self.spine(right, 0)
        ranks = self.ranks
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            both = ranks.get(x + y)
            # Of equal ranks the leftmost merges first: x's own merge, then x with y, then y's.
            if both is not None and both < x_ends and both <= y_ends:
                return False
            if x_ends == y_ends == _NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1


class Transducer:
    """Encodes pieces; see the module's text for what a state is."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.merges = Merges(ranks)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        self.sizes[list(ranks.values())] = [len(token) for token in ranks]
        # The trie: node and byte to node; per node whether longer entries go on, how deep it
        # lies, and the entry that ends there (None, or -1 - rank until known to be reachable).
        self.below: dict[int, int] = {}
        self.goes_on = [False]
        self.depth = [0]
        self.entry: list[int | None] = [None]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.below:
                    self.below[key] = len(self.entry)
                    self.goes_on[node] = True
                    self.goes_on.append(False)
                    self.depth.append(self.depth[node] + 1)
                    self.entry.append(None)
                node = self.below[key]
            self.entry[node] = -1 - rank
        self._apart: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: open starts as (node, token before that start), oldest first, and last the
        # present end as (0, token before it); -1 before the piece. Each pair is packed into
        # eight bytes, ``node << 32 | token + 1``.
        start = array("q", [0]).tobytes()
        self.states = [start]
        self.ends = [-1]
        self.numbers = {start: 0}
        self.moves: dict[int, int] = {}

    def _number(self, state: bytes, ended: int) -> int:
        known = self.numbers.get(state)
        if known is None:
            known = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.ends.append(ended)
        return known

    def _pairs(self, number: int) -> list[tuple[int, int]]:
        """The pairs of a state."""
        return [(p >> 32, (p & 0xFFFFFFFF) - 1) for p in array("q", self.states[number])]

    def _entry_at(self, node: int) -> int | None:
        rank = self.entry[node]
        if rank is not None and rank < 0:
            rank = -1 - rank
            if not self.merges.reachable(self.tokens[rank]):
                rank = None
            self.entry[node] = rank
        return rank

    def _are_apart(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        key = left + 1 << 32 | right
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) >= MAX_APART:
                self._apart.clear()
            known = self.merges.apart(self.tokens[left], self.tokens[right])
            self._apart[key] = known
        return known

    def _move(self, number: int, byte: int) -> int:
        """The state after ``byte``."""
        grown = array("q")
        ended = None
        below, goes_on, entry, apart = self.below, self.goes_on, self.entry, self._apart
        for pair in array("q", self.states[number]):
            node = below.get(pair >> 32 << 8 | byte)
            if node is None:
                continue
            before = pair & 0xFFFFFFFF
            if ended is None:
                token = entry[node]
                if token is not None and token < 0:
                    token = self._entry_at(node)
                if token is not None:
                    fits = apart.get(before << 32 | token)
                    if fits is None:
                        fits = self._are_apart(before - 1, token)
                    if fits:
                        ended = token
            if goes_on[node]:
                grown.append(node << 32 | before)
        if ended is None:
            raise ValueError(f"byte {byte} cannot be encoded by this vocabulary")
        grown.append(ended + 1)
        return self._number(grown.tobytes(), ended)

    def _finish(self, number: int, byte: int) -> int:
        """The last token if the piece ends with ``byte``."""
        move = self.moves.get(number << 8 | byte)
        if move is not None:
            return self.ends[move]
        below = self.below
        for node, before in self._pairs(number):
            node = below.get(node << 8 | byte)
            if node is not None:
                token = self._entry_at(node)
                if token is not None and self._are_apart(before, token):
                    return token
        raise ValueError(f"byte {byte} cannot be encoded by this vocabulary")

    def encode_piece(self, piece: bytes) -> list[int]:
        """The tokens of a piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > LONG:
            return list(self.stream(piece))
        if len(self.moves) + len(piece) > MAX_STATES:
            self._reset()
        state, ended = 0, []
        for byte in piece[:-1]:
            state = self._after(state << 8 | byte)
            ended.append(self.ends[state])
        ended.append(self._finish(state, piece[-1]))
        return self._chain(ended, len(ended))

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces one after another, and how many each piece has.

        The pieces take their steps together: at each place every pair of state and byte is
        looked up once for all pieces that share it.
        """
        flat, counts = [], []
        for at in range(0, len(pieces), TOGETHER):
            if len(self.moves) >= MAX_STATES:
                self._reset()
            tokens, count = self._encode_block(pieces[at : at + TOGETHER])
            flat.append(tokens)
            counts.append(count)
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *flat]), np.concatenate([none, *counts])

    def _encode_block(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        alone = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                alone[i] = [whole]
            elif len(piece) > SHORT:
                alone[i] = self.encode_piece(piece)
        sizes = np.array([len(p) for p in pieces])
        rows = np.array([i for i in range(len(pieces)) if i not in alone], np.int64)
        # The longest first: those that go on at a place are then the first ones.
        rows = rows[np.argsort(-sizes[rows], kind="stable")]
        lengths = sizes[rows]
        data = np.frombuffer(b"".join([pieces[i] for i in rows.tolist()]), np.uint8)
        starts = np.cumsum(lengths) - lengths
        states = np.zeros(len(rows), np.int64)
        ended = np.zeros((int(lengths.max(initial=0)), len(rows)), np.int32)
        for place in range(len(ended)):
            here, on = np.searchsorted(-lengths, [-place, -place - 1]).tolist()
            keys = states[:here] << 8 | data[starts[:here] + place]
            steps, which = np.unique(keys[:on], return_inverse=True)
            after = [self._after(key) for key in steps.tolist()]
            states[:on] = np.array(after, np.int64)[which]
            ended[place, :on] = np.array([self.ends[state] for state in after], np.int64)[which]
            steps, which = np.unique(keys[on:], return_inverse=True)
            last = [self._finish(key >> 8, key & 255) for key in steps.tolist()]
            ended[place, on:here] = np.array(last, np.int64)[which]
        # Follow the tokens back from the ends, again all pieces together.
        of = [np.full(len(tokens), i) for i, tokens in alone.items()]
        found = [np.array(tokens, np.int64) for tokens in alone.values()]
        still, left = np.arange(len(rows)), lengths.copy()
        while len(still):
            tokens = ended[left[still] - 1, still]
            of.append(rows[still])
            found.append(tokens)
            left[still] -= self.sizes[tokens]
            still = still[left[still] > 0]
        of, found = np.concatenate(of[::-1]), np.concatenate(found[::-1])
        return found[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(pieces))

    def _after(self, key: int) -> int:
        """The state after a state and a byte, joined as ``state << 8 | byte``."""
        state = self.moves.get(key)
        if state is None:
            state = self.moves[key] = self._move(key >> 8, key & 255)
        return state

    def stream(self, piece: bytes) -> Iterator[int]:
        """The tokens of a long piece, put out as soon as a look at every ``LONG`` bytes finds
        them final; what is kept does not grow with the piece."""
        ended, state = [], 0
        for place, byte in enumerate(piece, 1):
            if len(self.moves) >= MAX_STATES:
                here, last = self.states[state], self.ends[state]
                self._reset()
                state = self._number(here, last)
            state = self._after(state << 8 | byte)
            ended.append(self.ends[state])
            if place % LONG == 0 or place == len(piece):
                depths = [0] if place == len(piece) else [
                    self.depth[node] for node, _ in self._pairs(state)
                ]
                final = self._meeting(ended, [len(ended) - depth for depth in depths])
                yield from self._chain(ended, final)
                del ended[:final]

    def _meeting(self, ended: list[int], places: list[int]) -> int:
        """The last place that the chains of tokens back from all of ``places`` go through."""
        while len(set(places)) > 1:
            last = max(places)
            places = [p - len(self.tokens[ended[p - 1]]) if p == last else p for p in places]
        return places[0]

    def _chain(self, ended: list[int], place: int) -> list[int]:
        """The tokens that lead to a place."""
        out = []
        while place:
            out.append(ended[place - 1])
            place -= len(self.tokens[out[-1]])
        out.reverse()
        return out


class Utf8Decoder:
    """An incremental UTF-8 state machine over a stream of tokens.

    The state is the bytes of a character that is still open: how many more it needs, and
    the range its next byte must lie in. A byte that cannot continue it makes one U+FFFD for
    the bytes so far, and is looked at anew.
    """

    def __init__(self) -> None:
        self.open = b""
        self.needs = 0
        self.low, self.high = 0x80, 0xBF

    def _first(self, byte: int) -> str:
        self.low, self.high = 0x80, 0xBF
        if byte < 0x80:
            return chr(byte)
        if 0xC2 <= byte <= 0xDF:
            self.needs = 1
        elif 0xE0 <= byte <= 0xEF:
            self.needs = 2
            self.low = 0xA0 if byte == 0xE0 else 0x80
            self.high = 0x9F if byte == 0xED else 0xBF
        elif 0xF0 <= byte <= 0xF4:
            self.needs = 3
            self.low = 0x90 if byte == 0xF0 else 0x80
            self.high = 0x8F if byte == 0xF4 else 0xBF
        else:
            return "\ufffd"
        self.open = bytes([byte])
        return ""

    def push(self, token: bytes) -> str:
        """The characters that ``token``, or a run of tokens, completes."""
        out, at = [], 0
        while at < len(token):
            byte = token[at]
            if not self.needs:
                try:
                    out.append(token[at:].decode())
                    break
                except UnicodeDecodeError as stop:
                    out.append(token[at : at + stop.start].decode())
                    at += stop.start
                out.append(self._first(token[at]))
                at += 1
            elif self.low <= byte <= self.high:
                self.open += token[at : at + 1]
                self.needs -= 1
                self.low, self.high = 0x80, 0xBF
                if not self.needs:
                    out.append(self.open.decode())
                    self.open = b""
                at += 1
            else:
                self.needs, self.open = 0, b""
                out.append("\ufffd")
        return "".join(out)

    def end(self) -> str:
        """What an unfinished character becomes at the end of the stream."""
        rest, self.needs, self.open = self.needs, 0, b""
        return "\ufffd" if rest else ""


class Entry(NamedTuple):
    """The ids of pieces next to each other, as 32-bit numbers."""

    ids: np.ndarray


def _entry(found: list[bytes]) -> Entry:
    return Entry(np.frombuffer(b"".join(found), np.int32))


class Codec:
    """Encodes whole texts and decodes token ids, with a bounded memory of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int = MAX_PIECES):
        self.transducer = Transducer(ranks)
        self.tokens = self.transducer.tokens
        # By rank: where a token's bytes start among those of all, and its digits with a comma.
        self.starts = np.zeros(len(self.transducer.sizes), np.int64)
        ordered = sorted(self.tokens)
        self.flat = np.frombuffer(b"".join(map(self.tokens.get, ordered)), np.uint8)
        sizes = self.transducer.sizes[ordered]
        self.starts[ordered] = np.cumsum(sizes) - sizes
        self.digits = np.array([b"%d," % rank for rank in range(len(self.starts))], np.bytes_)
        self.pattern = regex.compile(pattern)
        self.max_pieces = max_pieces
        self.known: dict[str, bytes] = {}

    def _runs(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, in lists of bounded length."""
        if len(text) <= LISTED:
            yield self.pattern.findall(text)
            return
        matches = self.pattern.finditer(text)
        while run := [m[0] for m in islice(matches, LISTED // 8)]:
            yield run

    def _learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of pieces that are not known; all but very long ones are kept."""
        pieces, known = list(pieces), self.known
        ids, counts = self.transducer.encode_many([piece.encode("utf-8") for piece in pieces])
        packed = ids.astype(np.int32).tobytes()
        made, at = {}, 0
        for piece, end in zip(pieces, (4 * np.cumsum(counts)).tolist()):
            made[piece] = packed[at:end]
            if end - at <= 256:
                if len(known) >= self.max_pieces:
                    known.clear()
                known[piece] = made[piece]
            at = end
        return made

    def entries(self, text: str) -> Iterator[list[Entry]]:
        """Ids of the pieces of a text, in parts of bounded length."""
        known = self.known
        for run in self._runs(text):
            found = list(map(known.get, run))
            if None in found:
                made = self._learn({p for p, ids in zip(run, found) if ids is None})
                found = [ids or made[piece] for piece, ids in zip(run, found)]
            if found:
                yield [_entry(found)]

    def entries_of(self, texts: Iterable[str]) -> Iterator[Iterable[list[Entry]]]:
        """For each text what ``entries`` gives; texts next to each other learn together.

        More pieces take their steps together that way, and share more of them.
        """
        held: list[str] = []
        size = 0
        for text in texts:
            if held and size + len(text) > LISTED:
                yield from self._together(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        yield from self._together(held)

    def _together(self, texts: list[str]) -> Iterator[Iterable[list[Entry]]]:
        if len(texts) < 2:
            yield from map(self.entries, texts)
            return
        runs = list(map(self.pattern.findall, texts))
        found = [list(map(self.known.get, run)) for run in runs]
        made = self._learn(
            {p for run, have in zip(runs, found) for p, ids in zip(run, have) if ids is None}
        )
        for run, have in zip(runs, found):
            if None in have:
                have = [ids or made[piece] for piece, ids in zip(run, have)]
            yield [[_entry(have)]] if have else []

    def encode(self, text: str) -> list[int]:
        return [i for found in self.entries(text) for entry in found for i in entry.ids.tolist()]

    def decode_bytes(self, ids: np.ndarray) -> Iterator[bytes]:
        """The bytes of the tokens, in parts of bounded length."""
        for at in range(0, len(ids), PART):
            part = ids[at : at + PART]
            sizes = self.transducer.sizes[part]
            ends = np.cumsum(sizes)
            shifts = np.repeat(self.starts[part] - ends + sizes, sizes)
            yield self.flat[shifts + np.arange(len(shifts))].tobytes()

    def decimals(self, ids: np.ndarray) -> Iterator[bytes]:
        """The ids' decimal digits, a comma after each, in parts of bounded length."""
        for at in range(0, len(ids), PART):
            # The table's rows are filled up with zero bytes.
            yield self.digits[ids[at : at + PART]].tobytes().translate(None, b"\0")

    def decode(self, ids: list[int]) -> Iterator[str]:
        """The text of a stream of ids, piece by piece; no character is cut."""
        machine = Utf8Decoder()
        tokens = self.tokens
        for i in ids:
            if done := machine.push(tokens[i]):
                yield done
        if rest := machine.end():
            yield rest


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids``, the token ids of every whole text."""

    def start() -> Callable[[str], tuple]:
        codec = Codec(read_ranks(ranks_path), pattern)
        return lambda text: (codec.encode(text),)

    return map_texts(docs, start, "ids array<int>")


def _map_entries(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    row: Callable[[Codec, str, Iterable[list[Entry]]], tuple],
    schema: str,
) -> DataFrame:
    """``doc_id`` and the values of ``row`` for every whole text and its entries."""
    whole = f"doc_id long, {schema}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in slices(batches, ROWS):
            codec = codec or Codec(read_ranks(ranks_path), pattern)
            texts = batch.column("text").to_pylist()
            found = zip(batch.column("doc_id").to_pylist(), texts, codec.entries_of(texts))
            yield batch_of([(i, *row(codec, *pair)) for i, *pair in found], whole)

    return plain_texts(docs).mapInArrow(run, whole)


def encode_checked(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``text_sha256`` of every whole text.

    The ids are decoded again; a text that does not come back fails the job.
    """

    def row(codec: Codec, text: str, entries: Iterable[list[Entry]]) -> tuple:
        parts = [np.zeros(0, np.int32), *[entry.ids for found in entries for entry in found]]
        ids = np.concatenate(parts)
        machine = Utf8Decoder()
        back = "".join(map(machine.push, codec.decode_bytes(ids))) + machine.end()
        if back != text:
            raise ValueError("a text changed on its way through the tokens")
        return len(ids), ids, hashlib.sha256(text.encode()).hexdigest()

    schema = "n_tokens long, ids array<int>, text_sha256 string"
    return _map_entries(docs, ranks_path, pattern, row, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id`` and ``text`` from ``ids``; bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        for batch in batches:
            if tokens is None:
                tokens = {rank: token for token, rank in read_ranks(ranks_path).items()}
            rows = []
            pairs = zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist())
            for doc_id, ids in pairs:
                machine = Utf8Decoder()
                text = "".join([machine.push(tokens[i]) for i in ids or ()]) + machine.end()
                rows.append((doc_id, text))
            yield batch_of(rows, "doc_id long, text string")

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id long, text string"
    )


def round_trip_report(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of tokens, digest of the ids, digest of the bytes decoded."""

    def row(codec: Codec, text: str, entries: Iterable[list[Entry]]) -> tuple:
        count, listed, decoded = 0, hashlib.sha256(), hashlib.sha256()
        comma = b""
        machine = Utf8Decoder()
        for ids in (entry.ids for found in entries for entry in found):
            for part in codec.decimals(ids):
                listed.update(comma + part[:-1])
                comma = b","
            for part in codec.decode_bytes(ids):
                decoded.update(machine.push(part).encode())
            count += len(ids)
        decoded.update(machine.end().encode())
        return count, listed.hexdigest(), decoded.hexdigest()

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _map_entries(docs, ranks_path, pattern, row, schema)
