"""Byte-level BPE as a finite-state transducer that is determinised while it runs.

Merges by rank have a local description: a sequence of tokens is the encoding of its bytes exactly if each two neighbours are, and whether
two tokens may stand side by side follows from the order in which the bytes at their border were merged. So every
prefix of a text has one last token, and reading bytes from left to right needs only the starts that some token can still
reach. A state holds those starts, each with the bytes read since and the tokens not yet certain; a transition reads a
byte, extends the starts, and emits the tokens on which all starts agree. No start is further back than the longest token, which bounds
the lookahead. States and transitions are made when first needed.

The distinct new pieces of a slice of texts are read together, byte by byte: a state is made once for all pieces that share what was read, its
starts lie in flat arrays, and all transitions of a byte position are one round of array operations. The table of states is left when the
slice is done; what stays are the ids of pieces and words. A piece longer than ``LONG`` bytes is read alone, by the same transitions
in streaming form; there a piece adds one state at most, and when there are too many states the table starts anew.

Decoding joins the tokens' bytes; text is given out by an incremental UTF-8 machine that holds back an unfinished character.

Defined results: null text is empty, an empty text has no ids; ids are little-endian unsigned 32-bit integers in one binary value;
special tokens are ordinary text; ids that the vocabulary lacks fail to decode.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.runtime import hold, ship

#: Distinct pieces and words that a Python worker keeps beyond those of a slice, and states of the streaming form.
KEPT, STATES = 180_000, 50_000
#: Bytes of the longest piece that is read together with others, pieces in one round, and pairs of tokens kept.
LONG, ROUND, PAIRS = 64, 40_000, 2_000_000
#: Bytes of text, or of ids, that a task works on at a time.
SLICE = 2_000_000
NEVER = 1 << 62
#: Ids that are decoded at a time.
CHUNK = 65_536


#: Where a space follows white space, only spaces after other characters are cuts.
_RUN, _CUT = re.compile(r"\s "), re.compile(r"(?<=\S) ")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts whose merge gives ``token``; None if merging its bytes by rank never gives it."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not found:
            return None
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


@dataclass
class Merges:
    """What the transducer needs of a vocabulary: tokens that merging can reach, and the last merge of each."""

    ranks: dict[bytes, int]
    splits: dict[bytes, tuple[bytes, bytes]] = field(default_factory=dict)

    @classmethod
    def compile(cls, ranks: dict[bytes, int]) -> Merges:
        splits = {t: s for t in ranks if len(t) > 1 and (s := last_merge(t, ranks))}
        return cls(ranks, splits)


class Transducer:
    """States are (last certain token, starts); a start is (node of the trie of tokens, tokens not yet certain before it)."""

    def __init__(self, merges: Merges, pattern: str):
        self.ranks, self.splits = merges.ranks, merges.splits
        self.names = {i: t for t, i in merges.ranks.items()}
        self.find = regex.compile(pattern).findall
        child, token, inner = {}, [None], [True]
        for name, number in merges.ranks.items():
            if len(name) == 1 or name in merges.splits:
                node = 0
                for byte in name:
                    inner[node] = True
                    to = child.setdefault(node << 8 | byte, len(token))
                    if to == len(token):
                        token.append(None)
                        inner.append(False)
                    node = to
                token[node] = number
        #: (node, byte) to the next node, the token that ends there, and whether longer ones go on.
        self.child = {k: (to, token[to], inner[to]) for k, to in child.items()}
        self._flatten(child, token, inner)
        self.spines: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}
        self.pairs: dict[int, bool] = {}
        self.pieces, self.words = _Kept(), _Kept()
        self._forget()

    def _flatten(self, child: dict[int, int], token: list, inner: list[bool]) -> None:
        """The trie as arrays: a row of 256 next nodes for each node that goes on, -1 where there is none."""
        self.row = np.where(inner, np.cumsum(inner) - 1, -1).astype(np.int32)
        self.next = np.full((sum(inner), 256), -1, np.int32)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        self.next[self.row[keys >> 8], keys & 255] = np.fromiter(child.values(), np.int32, len(child))
        self.ends = np.array([-1 if t is None else t for t in token], np.int64)
        self.size = np.zeros(max(self.names) + 1, np.int64)
        self.size[list(self.names)] = [len(t) for t in self.names.values()]
        self.known, self.good = np.empty(0, np.int64), np.empty(0, bool)

    def _forget(self) -> None:
        start = (-1, ((0, ()),))
        self.states, self.index, self.moves = [start], {start: 0}, [{}]

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """What stood at the left (0) or right (1) edge of ``token`` over time, each with the rank that absorbed it."""
        known = self.spines.get((token, side))
        if known is None:
            known, until, part = [], NEVER, token
            while True:
                known.append((part, until))
                if part not in self.splits:
                    break
                until = self.ranks[part]
                part = self.splits[part][side]
            known.reverse()
            self.spines[token, side] = known
        return known

    def _fits(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` and ``b`` together encode as just these two tokens."""
        left, right = self._spine(self.names[a], 1), self._spine(self.names[b], 0)
        i = j = 0
        out = True
        while True:
            (x, until_x), (y, until_y) = left[i], right[j]
            across = self.ranks.get(x + y, NEVER)
            # Of merges of one rank the leftmost comes first: inside a, then across the border, then inside b.
            if across < until_x and across <= until_y:
                out = False
                break
            if until_x == until_y == NEVER:
                break
            if until_x <= until_y:
                i += 1
            else:
                j += 1
        return out

    def _pair(self, a: int, b: int) -> bool:
        if len(self.pairs) >= 2 * STATES:
            self.pairs.clear()
        out = self.pairs[a << 32 | b] = self._fits(a, b)
        return out

    def _fit(self, keys: np.ndarray) -> np.ndarray:
        """``_fits`` for many pairs; a pair is the first token times 2**32 plus the second."""
        at = np.searchsorted(self.known, keys)
        at[at == len(self.known)] = 0
        new = self.known[at] != keys if len(self.known) else np.ones(len(keys), bool)
        if new.any():
            fresh = np.unique(keys[new])
            if len(self.known) + len(fresh) > PAIRS:
                # Those of this call are found again, the others are asked for anew.
                fresh, self.known, self.good = np.unique(keys), self.known[:0], self.good[:0]
            fits = np.array([self._fits(k >> 32, k & 0xFFFFFFFF) for k in fresh.tolist()], bool)
            every, good = np.concatenate([self.known, fresh]), np.concatenate([self.good, fits])
            order = np.argsort(every, kind="stable")
            self.known, self.good = every[order], good[order]
            at = np.searchsorted(self.known, keys)
        return self.good[at]

    def run_many(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces, each of 1 to ``LONG`` bytes."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(lengths.max())
        padded = np.array(pieces, f"S{width}")
        order = np.argsort(padded, kind="stable")
        lengths, table = lengths[order], padded[order].view(np.uint8).reshape(-1, width)
        same = np.ones(len(pieces), bool)
        same[0] = False
        # Token that ends after each byte of each piece.
        last = np.empty((len(pieces), width), np.int64)
        # One state before the first byte: one start, at the root, after no token.
        state = np.zeros(len(pieces), np.int64)
        first, count, rows, before = np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, np.int32), np.full(1, -1, np.int64)
        for column in range(width):
            same[1:] &= table[1:, column] == table[:-1, column]
            here = np.flatnonzero(lengths > column)
            # Sorted pieces with the same bytes so far are neighbours and share a state.
            group = np.cumsum(~same)[here]
            opens = np.r_[True, group[1:] != group[:-1]]
            one, of = here[opens], np.cumsum(opens) - 1
            parent, byte = state[one], table[one, column]
            number = count[parent]
            whose = np.repeat(np.arange(len(one)), number)
            at = np.arange(len(whose)) + np.repeat(first[parent] - (np.cumsum(number) - number), number)
            to = self.next[rows[at], byte[whose]]
            live = np.flatnonzero(to >= 0)
            to, whose, prior = to[live], whose[live], before[at[live]]
            token = self.ends[to]
            ending = np.flatnonzero(token >= 0)
            a, b = prior[ending], token[ending]
            fits = a < 0
            later = np.flatnonzero(~fits)
            fits[later] = self._fit(a[later] << 32 | b[later])
            chosen = ending[fits][::-1]
            ends = np.full(len(one), -1, np.int64)
            ends[whose[chosen]] = token[chosen]
            last[here, column] = ends[of]
            # The next states: starts whose token may go on, and a new one after the token that ends here.
            on = np.flatnonzero(self.row[to] >= 0)
            to, whose, prior = to[on], whose[on], prior[on]
            count = np.bincount(whose, minlength=len(one)) + 1
            first = np.cumsum(count) - count
            rows, before = np.zeros(len(on) + len(one), np.int32), np.empty(len(on) + len(one), np.int64)
            old, new = np.arange(len(on)) + whose, first + count - 1
            rows[old], before[old], before[new] = self.row[to], prior, ends
            state[here] = of
        return self._emit(last, lengths, order)

    def _emit(self, last: np.ndarray, lengths: np.ndarray, order: np.ndarray) -> list[bytes]:
        """At its end a piece has one start, so all its tokens are certain: each is the one that ends where the next begins."""
        found, open_, at = [], np.arange(len(lengths)), lengths.copy()
        number = np.zeros(len(lengths), np.int64)
        while len(open_):
            token = last[open_, at[open_] - 1]
            found.append((open_, token))
            number[open_] += 1
            at[open_] -= self.size[token]
            open_ = open_[at[open_] > 0]
        ends = np.cumsum(number)
        flat = np.empty(int(ends[-1]), "<u4")
        for back, (which, token) in enumerate(found, 1):
            flat[ends[which] - back] = token
        data, cut = flat.tobytes(), np.empty((len(lengths), 2), np.int64)
        cut[order, 0], cut[order, 1] = 4 * (ends - number), 4 * ends
        return [data[i:j] for i, j in cut.tolist()]

    def _step(self, state: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        last, live = state
        starts, here, child, pairs = [], None, self.child, self.pairs
        for node, pending in live:
            found = child.get(node << 8 | byte)
            if found is None:
                continue
            to, token, inner = found
            if here is None and token is not None:
                before = pending[-1] if pending else last
                if before < 0 or (pairs[k] if (k := before << 32 | token) in pairs else self._pair(before, token)):
                    here = (*pending, token)
            if inner:
                starts.append((to, pending))
        if not starts:
            # Nothing longer can come of what was read.
            return (here[-1], ((0, ()),)), here
        if not starts[0][1]:
            starts.append((0, here))
            return (last, tuple(starts)), ()
        sure = len(here)
        for _, pending in starts:
            n = 0
            for x, y in zip(pending, here[:sure]):
                if x != y:
                    break
                n += 1
            sure = n
            if not sure:
                break
        if sure:
            last, starts = here[sure - 1], [(node, pending[sure:]) for node, pending in starts]
        starts.append((0, here[sure:]))
        return (last, tuple(starts)), here[:sure]

    def run(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES:
            self._forget()
        at, out, moves, states, state = 0, [], self.moves, self.states, None
        for byte in data:
            if state is not None:
                # Past the one new state of this piece: what comes once need not be kept.
                state, sure = self._step(state, byte)
                out += sure
                continue
            known = moves[at]
            move = known.get(byte)
            if move is None:
                state, sure = self._step(states[at], byte)
                out += sure
                to = self.index.get(state)
                if to is None:
                    to = self.index[state] = len(states)
                    states.append(state)
                    moves.append({})
                    known[byte] = (to, sure) if sure else to
                else:
                    known[byte] = (to, sure) if sure else to
                    at, state = to, None
            elif move.__class__ is int:
                at = move
            else:
                at, sure = move
                out += sure
        out += (states[at] if state is None else state)[1][-1][1]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """No piece reaches over a space that follows anything but white space: texts are cut there, and words kept by what follows."""
        cut = [_CUT.split(t) if _RUN.search(t) else t.split(" ") for t in texts]
        heads = [self.find(words.pop(0)) for words in cut]
        words = self.words.lacking(set().union(*cut))
        # A space and letters are one piece; most words that come once are of this kind.
        parts = [(f" {w}",) if w.isalpha() else self.find(f" {w}") for w in words]
        # Words of one piece are kept as words.
        inner = self.pieces.lacking({p for group in (*heads, *parts) if group.__class__ is list for p in group})
        ids = self._ids(list({*inner, *(group[0] for group in parts if group.__class__ is tuple)}))
        self.pieces.update((p, ids[p]) for p in inner)
        piece = self.pieces
        self.words.update(
            (w, ids[g[0]] if g.__class__ is tuple else b"".join([piece[p] for p in g])) for w, g in zip(words, parts, strict=True)
        )
        word = self.words.__getitem__
        out = [b"".join((*map(piece.__getitem__, head), *map(word, rest))) for head, rest in zip(heads, cut, strict=True)]
        self.pieces.age()
        self.words.age()
        return out

    def _ids(self, pieces: list[str]) -> dict[str, bytes]:
        out, short = {}, []
        for piece in pieces:
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                out[piece] = array("I", (whole,)).tobytes()
            elif len(data) <= LONG:
                short.append((piece, data))
            else:
                out[piece] = array("I", self.run(data)).tobytes()
        for i in range(0, len(short), ROUND):
            part = short[i : i + ROUND]
            out.update(zip((p for p, _ in part), self.run_many([d for _, d in part]), strict=True))
        return out

    def decode(self, ids: bytes) -> Iterator[bytes]:
        every = np.frombuffer(ids, "<u4")
        for i in range(0, len(every), CHUNK):
            yield b"".join(map(self.names.__getitem__, every[i : i + CHUNK].tolist()))


class _Kept(dict):
    """Results by text. The older half goes when there are too many; what is used stays."""

    def __init__(self):
        self.older, self.long = {}, []

    def lacking(self, texts: set[str]) -> list[str]:
        """Those of ``texts`` that are not known; the known ones are taken over from the older half."""
        new, older = texts - self.keys(), self.older
        found = new & older.keys()
        self.update((t, older[t]) for t in found)
        new -= found
        self.long = [t for t in new if len(t) > LONG]
        return list(new)

    def age(self) -> None:
        """Between slices, so that all of a slice's texts are there while it is put together."""
        for text in self.long:
            del self[text]
        if len(self) >= KEPT:
            self.older = dict(self)
            self.clear()


class Utf8Stream:
    """Incremental UTF-8: bytes in, whole characters out; an unfinished character waits for its rest.

    The state is the bytes of the unfinished character. Bytes that cannot be UTF-8 become U+FFFD.
    """

    def __init__(self):
        self.waiting = b""

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue
            length = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
            if length > back:
                cut -= back
            break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        out, self.waiting = self.waiting.decode("utf-8", "replace"), b""
        return out


def decode_text(machine: Transducer, ids: bytes) -> Iterable[str]:
    stream = Utf8Stream()
    for data in machine.decode(ids):
        yield stream.feed(data)
    yield stream.end()


_MACHINES: dict[str, Transducer] = {}


class Tokenizer:
    """A vocabulary on its way to the workers; each worker builds one machine and keeps it for later tasks."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ship(spark)
        self.name, self.pattern = f"{path}\n{pattern}", pattern
        # The vocabulary file sets the size, a few MB.
        self.merges = spark.sparkContext.broadcast(Merges.compile(read_ranks(path)))

    def machine(self) -> Transducer:
        hold("bpe", _MACHINES.clear)
        if self.name not in _MACHINES:
            # States hold no cycles, and walking over them again and again is half of the time.
            gc.disable()
            _MACHINES[self.name] = Transducer(self.merges.value, self.pattern)
        return _MACHINES[self.name]


def _slices(batches: Iterator[pa.RecordBatch], sized: str) -> Iterator[pa.RecordBatch]:
    """Parts of about SLICE bytes of column ``sized``, so that what is made of a part stays small; a row is never cut."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(sized)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE, "right")))
            yield batch.slice(at, to - at)
            at = to


def _with(batch: pa.RecordBatch, name: str, values: list, kind: pa.DataType, drop: str) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != drop]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(values, kind)], [*kept, name])


def encode_batches(tokenizer: Tokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with ``ids`` in place of ``text``."""
    machine = tokenizer.machine()
    for part in _slices(batches, "text"):
        ids = machine.encode_many([t or "" for t in part.column("text").to_pylist()])
        yield _with(part, "ids", ids, pa.binary(), "text")


def decode_batches(tokenizer: Tokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with ``decoded`` beside ``ids``; characters that the ids leave unfinished become U+FFFD."""
    machine = tokenizer.machine()
    for part in _slices(batches, "ids"):
        texts = ["".join(decode_text(machine, ids)) if ids else "" for ids in part.column("ids").to_pylist()]
        yield _with(part, "decoded", texts, pa.string(), "")


def _count_batches(tokenizer: Tokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in encode_batches(tokenizer, batches):
        yield _with(part, "n_tokens", [len(x) // 4 for x in part.column("ids").to_pylist()], pa.int64(), "ids")


def _rows(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    return docs.select(*((F.struct(*keep).alias("row"),) if keep else ()), F.col(text).alias("text"))


def _schema(rows: DataFrame, *added: tuple) -> T.StructType:
    return T.StructType([f for f in rows.schema.fields if f.name != "text"] + [T.StructField(n, t()) for n, t in added])


def encode_documents(docs: DataFrame, tokenizer: Tokenizer, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` in a struct ``row``, and ``ids``."""
    rows = _rows(docs, text, keep)
    return rows.mapInArrow(partial(encode_batches, tokenizer), _schema(rows, ("ids", T.BinaryType)))


def decode_documents(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """All columns, and ``decoded``: the text of ``ids``."""
    return encoded.mapInArrow(partial(decode_batches, tokenizer), _schema(encoded, ("decoded", T.StringType)))


def round_trip(docs: DataFrame, tokenizer: Tokenizer, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row``, ``ids`` and ``decoded``: encoding and decoding in one pass, so a task needs one machine."""
    rows = _rows(docs, text, keep)
    kinds = ("ids", T.BinaryType), ("decoded", T.StringType)
    return rows.mapInArrow(partial(_there_and_back, tokenizer), _schema(rows, *kinds))


def _there_and_back(tokenizer: Tokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return decode_batches(tokenizer, encode_batches(tokenizer, batches))


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, *, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``n_tokens`` of each document, with the columns ``keep`` in a struct ``row``; the ids do not leave the task."""
    rows = _rows(docs, text, keep)
    return rows.mapInArrow(partial(_count_batches, tokenizer), _schema(rows, ("n_tokens", T.LongType)))
