"""SentencePiece BPE in vectorised merge rounds: the words that a batch meets for the first time are merged together.

The symbols of all these words lie in one flat integer array. A round looks up the rank of every neighbouring pair, takes the smallest
rank of each word (a segmented minimum), merges all places of that rank from left to right, and closes the gaps; a word leaves when none of
its pairs is a piece. Merging all places at once equals merging them one by one unless a merge makes a pair that ranks before or beside the
one just merged. Pieces that can do so are marked when the vocabulary is compiled, and of them only the leftmost place is merged.

In a word of more than LONG characters a pair need not wait for the whole word: a piece has a bounded length, so the smallest rank
within that many symbols on either side cannot be touched by what happens further away. Such words take a number of rounds that does
not grow with their length.

Runs of spaces are settled after the word behind them: where pieces of spaces only are the last in rank, the run is merged from left to right,
with the word's own space if no merge took that.

Defined results: null text is empty; an empty text has the begin and end ids only (where asked for); ids are little-endian unsigned 32-bit
integers in one binary value; control strings inside a text are ordinary text; characters that the vocabulary lacks become
their UTF-8 bytes. Decoding drops control ids and the space put before a text; bytes that are no UTF-8 become U+FFFD each; ids outside the
vocabulary fail. Rows are independent: repeated rows give equal results, an empty table an empty one, and other columns are kept only
inside ``row``, so none can clash. The space symbol U+2581 in a text comes back as a space, as in the library.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.arrow import slices, with_column
from lectern.llm.runtime import hold, ship

SPACE = "▁"
NONE = np.iinfo(np.int32).max
#: Words of more characters are merged by windows.
LONG = 64
#: From so many words on a Python worker forgets those it knows, none longer than LONG characters.
KEPT = 200_000
#: Bytes of text, or of ids, that a task works on at a time.
SLICE = 1_000_000

_SEGMENT = re.compile(" *[^ ]*")


@dataclass(frozen=True)
class Vocabulary:
    """What encoding and decoding need of a model; the vocabulary file sets its size, a few MB."""

    surfaces: list[bytes | None]
    chars: np.ndarray
    char_ids: np.ndarray
    slots: np.ndarray
    slot_merged: np.ndarray
    rank: np.ndarray
    alone: np.ndarray
    spread: np.ndarray
    first_byte: int
    unknown: int
    begin: int
    end: int
    reach: int
    space_runs: tuple[tuple[int, ...], ...]

    @classmethod
    def compile(cls, path: str) -> Vocabulary:
        """Read a model file. Only BPE models with byte fallback that leave texts as they are, but for the space before, can be read."""
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        trainer, rules, kinds = model.trainer_spec, model.normalizer_spec, pb.ModelProto.SentencePiece
        plain = (
            trainer.model_type == pb.TrainerSpec.BPE and trainer.byte_fallback and not trainer.treat_whitespace_as_suffix
            and not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
            and rules.escape_whitespaces and not any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
        )
        if not plain:
            raise ValueError(f"not a plain BPE model with byte fallback: {path}")
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        order = {s: r for r, s in enumerate(sorted({-model.pieces[i].score for p, i in ids.items() if len(p) > 1}))}
        rank = np.full(len(model.pieces), NONE, np.int32)
        for piece, i in ids.items():
            if len(piece) > 1:
                rank[i] = order[-model.pieces[i].score]
        surfaces = [_surface(p, kinds) for p in model.pieces]
        singles = sorted((ord(p), i) for p, i in ids.items() if len(p) == 1)
        symbol = lambda part: ids.get(part, len(rank) + ord(part) if len(part) == 1 else -1)
        tied = np.flatnonzero(rank < NONE)
        tied = tied[np.bincount(rank[tied])[rank[tied]] > 1]
        alone, spread, longest, merges = np.zeros(len(rank), bool), np.zeros(len(rank), np.int64), max(map(len, ids)), {}
        alone[tied], spread[tied] = True, longest
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = symbol(piece[:cut]), symbol(piece[cut:])
                if left >= 0 and right >= 0:
                    merges[left << 21 | right] = i
                for part in (left, right):
                    if 0 <= part < len(rank) and rank[i] <= rank[part] < NONE:
                        alone[part] = True
            for start, size in ((a, n) for n in range(2, len(piece)) for a in range(len(piece) - n + 1)):
                part = ids.get(piece[start : start + size], -1)
                if part >= 0 and rank[i] <= rank[part]:
                    spread[part] = max(spread[part], len(piece) - size)
        slots, slot_merged = _table(merges)
        byte_ids = [i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE]
        if byte_ids != list(range(byte_ids[0], byte_ids[0] + 256)):
            raise ValueError(f"byte pieces are not in order: {path}")
        return cls(
            surfaces, np.array([c for c, _ in singles], np.int64), np.array([i for _, i in singles], np.int64), slots, slot_merged,
            rank, alone, spread, byte_ids[0], trainer.unk_id, trainer.bos_id, trainer.eos_id, longest, _space_runs(ids, rank),
        )


def _surface(piece, kinds) -> bytes | None:
    if piece.type == kinds.CONTROL:
        return None
    if piece.type == kinds.BYTE:
        return bytes([int(piece.piece[3:5], 16)])
    return " ⁇ ".encode() if piece.type == kinds.UNKNOWN else piece.piece.replace(SPACE, " ").encode()


def _space_runs(ids: dict[str, int], rank: np.ndarray) -> tuple[tuple[int, ...], ...]:
    """The ids of 0, 1, 2.. spaces up to the longest piece of spaces; nothing where runs cannot be settled apart from the words."""
    inner = [p for p in ids if SPACE in p[1:]]
    if not inner or SPACE not in ids or any(p.strip(SPACE) for p in inner) or {rank[ids[p]] for p in inner} != {rank[rank < NONE].max()}:
        return ()
    runs, stack = [()], []
    for _ in range(max(map(len, inner))):
        stack.append(SPACE)
        # All ranks are equal: the leftmost pair that can be merged is at the end, as what lies before it is settled.
        while len(stack) > 1 and stack[-2] + stack[-1] in ids:
            stack[-2:] = [stack[-2] + stack[-1]]
        runs.append(tuple(ids[p] for p in stack))
    return tuple(runs) if len(runs[-1]) == 1 else ()


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _place(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def _table(merges: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """An open hash table of pairs, at most a quarter full; a pair that finds its place taken goes to the next free one."""
    bits = max(4, (4 * len(merges)).bit_length())
    slots, merged = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
    left = np.fromiter(merges, np.int64, len(merges))
    values = np.fromiter(merges.values(), np.int64, len(merges))
    at = _place(left, bits)
    while len(left):
        free = slots[at] < 0
        slots[at[free]], merged[at[free]] = left[free], values[free]
        # Of several pairs that took one place the last one has it.
        rest = slots[at] != left
        left, values, at = left[rest], values[rest], (at[rest] + 1) & (len(slots) - 1)
    return slots, merged


class Encoder:
    """One vocabulary in a Python worker, with the words it met lately."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.bits = len(vocabulary.slots).bit_length() - 1
        self.known: dict[str, bytes] = {}

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        v, keys = self.v, left << 21 | right
        at = _place(keys, self.bits)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            found = v.slots[at]
            same = found == keys
            out[open_[same]] = v.slot_merged[at[same]]
            more = ~same & (found >= 0)
            open_, keys, at = open_[more], keys[more], (at[more] + 1) & (len(v.slots) - 1)
        return out

    def _pairs(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece and its rank of the pairs that begin at ``at``."""
        made = self._merged(symbols[at], symbols[at + 1])
        return made, np.where(made >= 0, self.v.rank[made], NONE)

    def merge(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words, one word after the other, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.searchsorted(self.v.chars, points)
        at[at == len(self.v.chars)] = 0
        symbols = np.where(self.v.chars[at] == points, self.v.char_ids[at], len(self.v.rank) + points)
        word = np.repeat(np.arange(len(words)), lengths)
        long_ = np.repeat(lengths > LONG, lengths)
        parts = [self._rounds(symbols[~long_], word[~long_])]
        if long_.any():
            parts.append(self._windows(symbols[long_], word[long_]))
        symbols, word = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(words))

    def _rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds with the smallest rank of each word, until no pair remains."""
        done_symbols, done_words = [], []
        made, rank = self._start(symbols, word)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[starts, len(word)])
            least = np.minimum.reduceat(rank, starts)
            if (least == NONE).any():
                over = np.repeat(least == NONE, counts)
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, made, rank = symbols[~over], word[~over], made[~over], rank[~over]
                counts, least = counts[least < NONE], least[least < NONE]
                starts = np.cumsum(counts) - counts
                if not len(symbols):
                    break
            hit = rank == np.repeat(least, counts)
            places = np.flatnonzero(hit)
            first = np.r_[True, word[places[1:]] != word[places[:-1]]]
            places = places[first | ~self.v.alone[made[places]]]
            symbols, word, made, rank = self._join(symbols, word, made, rank, _every_other(places))
        return np.concatenate([symbols, *done_symbols]), np.concatenate([word, *done_words])

    def _windows(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds with the smallest rank within a piece's length."""
        reach = self.v.reach
        made, rank = self._start(symbols, word)
        while (rank < NONE).any():
            before, after, far_before, far_after = _least_around(rank, word, reach)
            run = np.r_[True, (rank[1:] != rank[:-1]) | (word[1:] != word[:-1])]
            good = (rank <= before) & (rank <= after) & (rank < NONE)
            # What a marked piece sets off must not meet what others set off before it, nor what the same piece does further left.
            marked = np.flatnonzero(good & self.v.alone[made])
            good[marked[(rank[marked] > far_before[marked]) | (rank[marked] > far_after[marked])]] = False
            good[self._close(word, made, rank)] = False
            # Pairs of equal symbols overlap: every other one counts, from the first of the run, if that may be merged.
            start = np.maximum.accumulate(np.where(run, np.arange(len(run)), 0))
            good &= good[start] & ((np.arange(len(run)) - start) % 2 == 0)
            symbols, word, made, rank = self._join(symbols, word, made, rank, np.flatnonzero(good))
        return symbols, word

    def _close(self, word: np.ndarray, made: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Marked pairs with one of the same rank so little before them that what both set off could meet."""
        at = np.flatnonzero((rank < NONE) & self.v.alone[made])
        at = at[np.argsort(rank[at], kind="stable")]
        before, after = at[:-1], at[1:]
        near = after - before <= 2 * self.v.spread[made[after]] + 2
        return after[near & (rank[before] == rank[after]) & (word[before] == word[after])]

    def _start(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        made, rank = np.full(len(symbols), -1, np.int64), np.full(len(symbols), NONE, np.int32)
        inside = np.flatnonzero(word[1:] == word[:-1])
        made[inside], rank[inside] = self._pairs(symbols, inside)
        return made, rank

    def _join(self, symbols, word, made, rank, places):
        """Merge the pairs that begin at ``places``, close the gaps, and look up the pairs that are new."""
        symbols[places] = made[places]
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        at = places - np.arange(len(places))
        symbols, word, made, rank = symbols[keep], word[keep], made[keep], rank[keep]
        touched = np.r_[at, at[at > 0] - 1]
        made[touched], rank[touched] = -1, NONE
        touched = touched[touched + 1 < len(word)]
        touched = touched[word[touched] == word[touched + 1]]
        made[touched], rank[touched] = self._pairs(symbols, touched)
        return symbols, word, made, rank

    def _values(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word; characters that the vocabulary lacks become bytes."""
        symbols, counts = self.merge(words)
        n = len(self.v.rank)
        odd = np.flatnonzero(symbols >= n)
        if len(odd):
            sizes = np.ones(len(symbols), np.int64)
            points = symbols[odd] - n
            sizes[odd] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            ends = np.cumsum(sizes)
            spread = np.repeat(symbols, sizes)
            raw = np.frombuffer("".join(map(chr, points.tolist())).encode(), np.uint8)
            spread[spread >= n] = raw.astype(np.int64) + self.v.first_byte
            counts = np.diff(np.r_[0, np.r_[0, ends][np.cumsum(counts)]])
            symbols = spread
        data = symbols.astype("<u4").tobytes()
        at = 0
        for to in (4 * np.cumsum(counts)).tolist():
            yield data[at:to]
            at = to

    def _segments(self, text: str) -> list[str]:
        """Words with the spaces before them; a text begins with one space more than it has. No piece reaches past a space after a word."""
        text = text.replace(SPACE, " ")
        if "  " not in text and text[:1] != " " and self.v.space_runs:
            return text.split(" ")
        found = _SEGMENT.findall(" " + text)[:-1]
        return [s[1:] if s.startswith(" ") and not s.startswith("  ") else s for s in found]

    def _encode_new(self, segments: list[str]) -> dict[str, bytes]:
        """Segments are words without their one space, or begin with the two spaces or more of a run."""
        runs = self.v.space_runs
        if not segments:
            return {}
        if not runs:
            words = [(s if s.startswith("  ") else " " + s).replace(" ", SPACE) for s in segments]
            return dict(zip(segments, self._values(words)))
        spaced = [s for s in segments if s.startswith("  ")]
        out = dict(zip(segments, self._values([SPACE + (s.lstrip(" ") if s[:1] == " " else s) for s in segments])))
        bare, longest = np.uint32(runs[1][0]).tobytes(), len(runs) - 1
        for segment in spaced:
            n, value = len(segment) - len(segment.lstrip(" ")), out[segment]
            n, rest = (n, value[4:]) if value[:4] == bare else (n - 1, value)
            ids = runs[longest] * (n // longest) + runs[n % longest]
            out[segment] = np.array(ids, "<u4").tobytes() + rest
        return out

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text, between the begin and end ids."""
        lists = [self._segments(t) if t else [] for t in texts]
        every = set().union(*lists)
        new = self._encode_new(list(every.difference(self.known)))
        if len(self.known) + len(new) > KEPT:
            new |= {segment: self.known[segment] for segment in every.intersection(self.known)}
            self.known = {}
        table = self.known
        table |= new
        begin, end = np.uint32(self.v.begin).tobytes(), np.uint32(self.v.end).tobytes()
        out = [b"".join([begin, *map(table.__getitem__, segments), end]) for segments in lists]
        for segment in [s for s in new if len(s) > LONG]:
            del table[segment]
        return out

    def decode(self, ids: bytes) -> str:
        surfaces = self.v.surfaces
        every = np.frombuffer(ids, "<u4").tolist()
        # Control ids part the bytes on their sides, as the library has it.
        parts = [[]]
        first = None
        for i in every:
            surface = surfaces[i]
            if surface is None:
                if parts[-1]:
                    parts.append([])
                continue
            if first is None:
                first = i
                if surface[:1] == b" " and i != self.v.unknown and not self.v.first_byte <= i < self.v.first_byte + 256:
                    surface = surface[1:]
            parts[-1].append(surface)
        return "".join([b"".join(part).decode("utf-8", "each-byte") for part in parts])


codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


def _every_other(places: np.ndarray) -> np.ndarray:
    """Of pairs that overlap in a row, the first, third, fifth.."""
    run = np.r_[True, np.diff(places) != 1]
    start = np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))
    return places[(np.arange(len(places)) - start) % 2 == 0]


def _least_around(rank: np.ndarray, word: np.ndarray, reach: int) -> tuple[np.ndarray, ...]:
    """The smallest rank among the ``reach`` pairs before and after each pair within its word, and among twice as many."""
    starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    lengths = np.diff(np.r_[starts, len(word)])
    gap = 2 * reach
    place = np.arange(len(rank)) + gap * (1 + np.repeat(np.arange(len(starts)), lengths))
    padded = np.full(place[-1] + 1 + gap, NONE, np.int32)
    padded[place] = rank

    def wider(least: np.ndarray, step: int) -> np.ndarray:
        return np.r_[np.minimum(least[:-step], least[step:]), np.full(step, NONE, np.int32)]

    near, width = padded, 1
    while width < reach:
        step = min(width, reach - width)
        near, width = wider(near, step), width + step
    far = wider(near, reach)
    # near[i] covers reach pairs from i on, far[i] twice as many.
    return near[place - reach], near[place + 1], far[place - gap], far[place + 1]


_ENCODERS: dict[str, Encoder] = {}


class PieceTokenizer:
    """A model on its way to the workers; each worker builds one encoder and keeps it for later tasks."""

    def __init__(self, spark: SparkSession, path: str):
        ship(spark)
        self.path = path
        self.vocabulary = spark.sparkContext.broadcast(Vocabulary.compile(path))

    def encoder(self) -> Encoder:
        hold("piece_bpe", _ENCODERS.clear)
        if self.path not in _ENCODERS:
            _ENCODERS[self.path] = Encoder(self.vocabulary.value)
        return _ENCODERS[self.path]


def encode_batches(tokenizer: PieceTokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with ``ids`` in place of ``text``."""
    encoder = tokenizer.encoder()
    for part in slices(batches, "text", SLICE):
        yield with_column(part, "ids", encoder.encode(part.column("text").to_pylist()), pa.binary(), drop="text")


def decode_batches(tokenizer: PieceTokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with ``decoded`` beside ``ids``."""
    encoder = tokenizer.encoder()
    for part in slices(batches, "ids", SLICE):
        texts = [None if ids is None else encoder.decode(ids) for ids in part.column("ids").to_pylist()]
        yield with_column(part, "decoded", texts, pa.string())


def _there_and_back(tokenizer: PieceTokenizer, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return decode_batches(tokenizer, encode_batches(tokenizer, batches))


def _rows(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    return docs.select(*((F.struct(*keep).alias("row"),) if keep else ()), F.col(text).alias("text"))


def _schema(rows: DataFrame, *added: tuple) -> T.StructType:
    return T.StructType([f for f in rows.schema.fields if f.name != "text"] + [T.StructField(n, t()) for n, t in added])


def encode_documents(docs: DataFrame, tokenizer: PieceTokenizer, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` in a struct ``row``, and ``ids``."""
    rows = _rows(docs, text, keep)
    return rows.mapInArrow(partial(encode_batches, tokenizer), _schema(rows, ("ids", T.BinaryType)))


def decode_documents(encoded: DataFrame, tokenizer: PieceTokenizer) -> DataFrame:
    """All columns, and ``decoded``: the text of ``ids``; null ids stay null."""
    return encoded.mapInArrow(partial(decode_batches, tokenizer), _schema(encoded, ("decoded", T.StringType)))


def round_trip(docs: DataFrame, tokenizer: PieceTokenizer, *, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row``, ``ids`` and ``decoded``, in one pass over the texts."""
    rows = _rows(docs, text, keep)
    kinds = ("ids", T.BinaryType), ("decoded", T.StringType)
    return rows.mapInArrow(partial(_there_and_back, tokenizer), _schema(rows, *kinds))
