"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if every token is what merging
makes of its own bytes, and every two neighbours stay as they are side by side.  So a
transducer can read bytes from the left.  A hypothesis is a place in the vocabulary's trie
and the token before it; after every byte exactly one token ends the encoding of what has
been read, and that token is the transition's output.  Sets of hypotheses become states
when they are first met.  No hypothesis is longer than the longest token, so the lookahead
is bounded: where only one is left, all tokens before it are settled and emitted.
"""

from __future__ import annotations

import base64
import ctypes
import gc
import hashlib
import threading
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sparkdesk.llm.common import documents

#: What a worker remembers in a generation: states (with about twice as many steps), pieces and
#: pairs of tokens, about 0.5, 0.2 and 0.1 kB each.  The generation before stays, and what is
#: asked for comes back from it, so frequent ones are never lost.
MAX_STATES, MAX_PIECES, MAX_PAIRS = 130_000, 180_000, 100_000
#: Two numbers below this bit's value are kept as one.
SHIFT = 20
LOW = (1 << SHIFT) - 1

#: A text is cut into so many pieces, and decoded in so many ids, at a time.
CHUNK = 50_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of lines "base64 of the token, its rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Generations(dict):
    """Remembers at most twice ``limit`` values: when it is full, what it holds becomes the old
    generation, from which a value that is asked for comes back."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Transducer:
    """Encodes one piece (bytes) as ids; needs a rank for each single byte it meets."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.tokens = {i: t for t, i in ranks.items()}
        self.names = {i: str(i) for i in self.tokens}
        self.halves: dict[int, tuple[int, int]] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.child: dict[int, int] = {}
        self.token_at, self.inner = [-1], [False]
        for token, rank in ranks.items():
            if len(token) > 1 and not self._made(token, rank):
                continue  # never a result of merging; only a whole piece can be this token
            node = 0
            for byte in token:
                self.inner[node] = True
                nxt = self.child.get(node << 8 | byte)
                if nxt is None:
                    nxt = self.child[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = nxt
            self.token_at[node] = rank
        #: No hypothesis is longer, so this is how far the transducer looks ahead.
        self.lookahead = max(map(len, ranks), default=1)
        self.pairs = Generations(lambda ab: self._stay(self._edge(ab >> SHIFT, 1), self._edge(ab & LOW, 0)), MAX_PAIRS)
        self.start = (-1 << SHIFT,)
        self.made = 0
        self.states, self.index, self.steps = {0: self.start}, {self.start: 0}, {}
        self._age()

    def merged(self, piece: bytes) -> list[int]:
        """The encoding by its definition: the lowest-ranked neighbours merge first."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _made(self, token: bytes, rank: int) -> bool:
        """Whether merging makes the token; notes the two halves of its last merge."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            low, i = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if low == 1 << 60:
                return False
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if b"".join(parts) != token:
            return False
        self.halves[rank] = (self.ranks[parts[0]], self.ranks[parts[1]])
        return True

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """The parts that stand at one edge of the token while it is merged: (bytes, from, until), by rank."""
        known = self.edges[side].get(token)
        if known is None:
            known, until, part = [], 1 << 60, token
            while part in self.halves:
                known.append((self.tokens[part], part, until))
                until, part = part, self.halves[part][side]
            known.append((self.tokens[part], -1, until))
            self.edges[side][token] = known
        return known

    def neighbours(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` side by side stay as they are: no part at the right edge of
        ``a`` merges with one at the left edge of ``b`` while both stand (of two equal merges
        the left one is first)."""
        return self.pairs[a << SHIFT | b]

    def _stay(self, left: list[tuple[bytes, int, int]], right: list[tuple[bytes, int, int]]) -> bool:
        for x, x_from, x_until in left:
            for y, y_from, y_until in right:
                if y_from < x_until and x_from <= y_until:
                    rank = self.ranks.get(x + y)
                    if rank is not None and rank < x_until and rank <= y_until:
                        return False
        return True

    def _age(self) -> None:
        """What is remembered becomes the old generation; each holds its start and all that its steps lead to."""
        self.old = self.states, self.index, self.steps
        self.states, self.index, self.steps = {0: self.start}, {self.start: 0}, {}

    def hypotheses(self, state: int) -> tuple[int, ...]:
        """Each hypothesis is its last token and its node, packed into one number."""
        known = self.states.get(state)
        return self.old[0][state] if known is None else known

    def step(self, state: int, byte: int) -> int:
        """The next state and the token that ends the encoding so far, packed; made when first asked for."""
        key = state << 8 | byte
        found = self.old[2].get(key)
        if found is None:
            after, ends = self._after(self.hypotheses(state), byte)
            nxt = self.index.get(after)
            if nxt is None:
                nxt = self.old[1].get(after)
            if nxt is None:
                self.made += 1
                nxt = self.made
            found = nxt << SHIFT | ends
        else:
            nxt = found >> SHIFT
            after = self.hypotheses(nxt)
        if nxt not in self.states:
            self.states[nxt], self.index[after] = after, nxt
        self.steps[key] = found
        return found

    def _after(self, hypotheses: tuple[int, ...], byte: int) -> tuple[tuple[int, ...], int]:
        child, token_at, inner = self.child, self.token_at, self.inner
        after, ends = [], -1
        for packed in hypotheses:
            last, node = packed >> SHIFT, packed & LOW
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            token = token_at[node]
            if token >= 0 and ends < 0 and (last < 0 or self.neighbours(last, token)):
                ends = token
            if inner[node]:
                after.append(last << SHIFT | node)
        if ends < 0:
            raise ValueError(f"no token for byte {byte}")
        after.append(ends << SHIFT)
        return tuple(after), ends

    def _settle(self, ends: list[int]) -> list[int]:
        """The tokens of a path, from the token that ends at each of its bytes."""
        out, i, tokens = [], len(ends), self.tokens
        while i > 0:
            token = ends[i - 1]
            out.append(token)
            i -= len(tokens[token])
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states:
            self._age()
        known, state, ends = self.steps, 0, []
        if len(piece) <= 2 * self.lookahead:
            for byte in piece:
                found = known.get(state << 8 | byte) or self.step(state, byte)
                state = found >> SHIFT
                ends.append(found & LOW)
            return self._settle(ends)
        out = []
        for byte in piece:
            found = self.steps.get(state << 8 | byte) or self.step(state, byte)
            state = found >> SHIFT
            ends.append(found & LOW)
            # one hypothesis left: all tokens up to here are settled
            if len(ends) >= self.lookahead and len(self.hypotheses(state)) == 1:
                out += self._settle(ends)
                ends = []
            if len(self.states) > self.max_states:
                here = self.hypotheses(state)
                self._age()
                self.states[state], self.index[here] = here, state
        return out + self._settle(ends)


class Pieces(Generations):
    """piece -> its ids, found when first asked for; long pieces are not kept."""

    def __init__(self, transducer: Transducer, limit: int = MAX_PIECES):
        super().__init__(lambda piece: tuple(transducer.encode(piece.encode())), limit)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        return super().__missing__(piece) if len(piece) <= 64 else self.make(piece)


class Utf8Machine:
    """Reads bytes one after another; knows how many continuation bytes are still due, and
    the range that the next one must be in."""

    def __init__(self):
        self.due, self.low, self.high = 0, 0x80, 0xBF

    def read(self, byte: int) -> bool:
        """False if the byte cannot stand here (then the machine starts anew)."""
        if self.due:
            good = self.low <= byte <= self.high
            self.due, self.low, self.high = (self.due - 1 if good else 0), 0x80, 0xBF
            return good
        if byte < 0x80:
            return True
        if 0xC2 <= byte <= 0xF4:
            self.due = 1 + (byte >= 0xE0) + (byte >= 0xF0)
            self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
            self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
            return True
        return False


class StreamDecoder:
    """Gives text as ids come; bytes of an unfinished character wait for the next ids."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.rest = tokens, b""

    def feed(self, ids: Iterable[int]) -> str:
        data = self.rest + b"".join(map(self.tokens.__getitem__, ids))
        lead = next((i for i in range(len(data) - 1, max(-1, len(data) - 4), -1) if data[i] & 0xC0 != 0x80), None)
        machine = Utf8Machine()
        whole = lead is None or not all(machine.read(b) for b in data[lead:]) or not machine.due
        cut = len(data) if whole else lead
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.rest = self.rest, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Whole texts to ids and back, in bounded chunks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.transducer = Transducer(ranks)
        self.pieces = Pieces(self.transducer)

    def encode(self, text: str) -> Iterator[list[int]]:
        if len(text) <= 4 * CHUNK:
            yield list(chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(text))))
            return
        found = self.pattern.finditer(text)
        while part := [m.group() for m in islice(found, CHUNK)]:
            yield list(chain.from_iterable(map(self.pieces.__getitem__, part)))

    def digest(self, text: str, keep_ids: bool) -> tuple[int, str, str, bool, list[int] | None]:
        """(tokens, SHA-256 of the ids, SHA-256 of the decoded bytes, whether decoding gives the text, ids)."""
        n, ids_sha, bytes_sha, ids = 0, hashlib.sha256(), hashlib.sha256(), []
        names = self.transducer.names
        decoder, at, same = StreamDecoder(self.transducer.tokens), 0, True
        for part in self.encode(text):
            if not part:
                continue
            ids_sha.update(("," * bool(n) + ",".join(map(names.__getitem__, part))).encode())
            n += len(part)
            said = decoder.feed(part)
            bytes_sha.update(said.encode())
            same, at = same and text.startswith(said, at), at + len(said)
            if keep_ids:
                ids += part
        said = decoder.finish()
        bytes_sha.update(said.encode())
        same = same and not said and at == len(text)
        return n, ids_sha.hexdigest(), bytes_sha.hexdigest(), same, ids if keep_ids else None


#: A worker without a task for so many seconds gives the memory of its codec back.
IDLE_SECONDS = 1.0


class Keeper:
    """One codec a worker process, so that what it has learnt is shared by the process's tasks.

    An idle worker outlives its tasks; a timer drops the codec, so that later stages do not
    run beside what the encoding remembered.
    """

    def __init__(self):
        self.lock, self.users, self.timer = threading.Lock(), 0, None
        self.key = self.codec = None

    def take(self, ranks: dict[bytes, int], pattern: str) -> Codec:
        with self.lock:
            if self.timer:
                self.timer.cancel()
            self.users += 1
            key = (hash(frozenset(ranks.items())), pattern)
            if key != self.key:
                self.key, self.codec = key, Codec(ranks, pattern)
            return self.codec

    def give_back(self) -> None:
        with self.lock:
            self.users -= 1
            self.timer = threading.Timer(IDLE_SECONDS, self._drop)
            self.timer.daemon = True
            self.timer.start()

    def _drop(self) -> None:
        with self.lock:
            if not self.users:
                self.key = self.codec = None
                gc.collect()  # the codec's parts refer to each other
                pa.default_memory_pool().release_unused()
                trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
                if trim:  # of the GNU C library: what was freed goes back to the machine
                    trim(0)


_KEEPER = Keeper()


def worker_keeper() -> Keeper:
    """The keeper of the process that calls this; tasks ask for it, as a keeper cannot be sent."""
    return _KEEPER


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, *, keep_ids: bool = False,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip (and token_ids).

    Every match of ``pattern`` in the whole text is encoded by the ranks of the file at
    ``ranks_path`` (read once on the driver; of fixed size, sent to the executors), without
    special tokens; the ids are decoded again.  No shuffle; a lost executor costs its tasks.

    Null and empty texts have no tokens; very long ones are worked on in chunks; ties and
    repeated rows are encoded alike; an empty table gives no rows; other columns are ignored.
    """
    d = documents(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    id_type = d.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, round_trip boolean"
              + ", token_ids array<int>" * keep_ids)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeper = worker_keeper()
        codec = keeper.take(sent.value, pattern)
        try:
            for batch in batches:
                done = [codec.digest(t.as_py(), keep_ids) for t in batch.column(1)]
                cols = list(zip(*done)) if done else [()] * 5
                types = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32())]
                arrays = [pa.array(c, type=t) for c, t in zip(cols[:4 + keep_ids], types)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip",
                                                  "token_ids"][:5 + keep_ids])
        finally:
            keeper.give_back()

    return d.mapInArrow(work, schema)
