"""SentencePiece encoding and decoding: a streaming Viterbi search over a piece vocabulary with byte fallback.

A trellis has a boundary before each character and after the last; an arc is a piece from one boundary to another. Each
boundary keeps the one best path to it, as a backpointer. In a unigram model that is the path of the greatest sum of scores.
In a merge (BPE) model an arc carries a path on only if its piece can follow the path's last piece: if merging the characters
of the two, best score first, ends in just these two. Pieces that follow each other pairwise so are what merging the whole text
gives, so one path to each boundary survives, and ids equal those of the SentencePiece library.

Only boundaries within the longest piece of the reading point can still begin a piece; their backpointer paths are followed
now and then, and once all of them pass through one boundary, everything before it is final: its ids are committed and its
boundaries forgotten.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Recent, in_arrow, table

MARK = "▁"  # stands for a space in pieces
#: Bytes of spans and their ids, and pairs of pieces, that a worker remembers.
REMEMBERED, PAIRS = 320 << 20, 400_000
LOW = float("-inf")
#: While a text is split at spaces: parts that stand for a mark, or a full stop and a line feed, after a word; and what a part begins with that no space goes before.
STOP, COMMA, LINE, BARE = "\x01", "\x02", "\x03", "\x04"
MARKS = {STOP: ".", COMMA: ",", LINE: ".\n"}
_span = re.compile(" +[^ ]*").findall


class Vocabulary:
    """Pieces, their scores and the bytes of a model; a piece that isn't ordinary text (control, unknown) is never made."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], merges: bool):
        self.byte_ids, self.merges = byte_ids, merges
        self.bytes_of = {i: bytes([b]) for b, i in byte_ids.items()} | {i: p.encode() for p, (i, _) in pieces.items()}
        self.text_of = {i: p for p, (i, _) in pieces.items()}
        self.known = pieces
        self.automaton = self._automaton()
        #: A character without a piece costs more than any piece, and once more for each of its bytes.
        self.fallback = min((x for _, x in pieces.values()), default=0.0) - 10.0
        self.longest = max(map(len, pieces), default=1)
        #: Characters side by side in some piece: between two others every path has a boundary.
        self.joined = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.pairs: dict[int, bool] = {}
        self.edges: dict[tuple[int, bool], list] = {}

    def _automaton(self):
        """Finds all pieces of a text in one pass, at each end the longest first."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for piece, (i, score) in self.known.items():
            found.add_word(piece, (i, len(piece), score))
        if len(found):
            found.make_automaton()
        return found

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """Of a model file. Merge models score their pieces by rank, in whole numbers; unigram models by log probability."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ordinary = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(model.get_piece_size()) if model.is_byte(i)}
        if len(byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        pieces = {model.id_to_piece(i).replace(MARK, " "): (i, model.get_score(i)) for i in ordinary}
        return cls(pieces, byte_ids, all(float(x).is_integer() for _, x in pieces.values()))

    def bytes_ids(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    def edge(self, piece: int, right: bool) -> list[tuple[str, float]]:
        """What stands at a piece's right or left edge while it is merged: from a character to the piece itself, each with the
        place in the order of merges at which it is merged into the next (never, for the piece). Empty if merging its
        characters doesn't give the piece."""
        key = (piece, right)
        if (out := self.edges.get(key)) is None:
            parts, out, last = list(self.text_of[piece]), [], 0.0
            while len(parts) > 1 and (best := self._best(parts)):
                place, at = best
                last = max(last, place)
                if at == (len(parts) - 2 if right else 0):
                    out.append((parts[-1 if right else 0], last))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            out = self.edges[key] = [*out, (parts[0], float("inf"))] if len(parts) == 1 else []
        return out

    def _best(self, parts: list[str]) -> tuple[float, int] | None:
        """The next merge of neighbours: its place in the order of all merges, and where it is; of equal ones the leftmost."""
        known = self.known.get
        return min(((-x[1], i) for i in range(len(parts) - 1) if (x := known(parts[i] + parts[i + 1]))), default=None)

    def may_follow(self, before: int | list[int] | None, piece: int) -> bool:
        """Whether merging leaves the two pieces as they are; nothing merges with bytes or with the text's beginning.

        The edges at the cut go through their merges in order. Wherever the two that stand there at a time could be merged
        before either goes into its own next merge, the cut is crossed; of merges with one place the leftmost is first.
        """
        right = self.edge(piece, False)
        if type(before) is not int:
            return bool(right)
        left = self.edge(before, True)
        if not left or not right:
            return False
        known, i, j = self.known.get, 0, 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            if (crossing := known(x + y)) and -crossing[1] < x_until and -crossing[1] <= y_until:
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1


def stream(text: str, v: Vocabulary, commit: Callable[[list[int]], None]) -> int:
    """Hands ids of the best segmentation of `text` to `commit`, in order; returns the most boundaries held at once.

    Boundaries are kept from the last committed one on. Whether the paths have converged is asked again after as many
    characters as the longest piece has, and after twice as many each time that they haven't: under a unigram model two paths
    can go on side by side in periodic text, and then this stays linear in the text. Of equal scores the longer last piece wins.
    """
    n, longest, base, held = len(text), v.longest, 0, 0
    best, back, made = [0.0], [0], [None]
    ask = wait = 2 * longest
    end, score, at, piece = 1, LOW, 0, None
    for last, arc in chain(v.automaton.iter(text) if v.known else (), ((n, None),)):
        while last >= end:  # no more arcs end at this boundary
            if piece is None or not v.merges and text[end - 1] not in v.known:
                ids = v.bytes_ids(text[end - 1])
                total = best[end - 1 - base] + v.fallback * len(ids)
                if piece is None or total > score:
                    score, at, piece = total, end - 1, ids
            best.append(score)
            back.append(at)
            made.append(piece)
            if end >= ask and end < n:
                held = max(held, end - base)
                live = set(range(max(base, end - longest + 1), end + 1))
                while len(live) > 1:  # the latest steps back until all are one: the paths' last common boundary
                    live.remove(latest := max(live))
                    live.add(back[latest - base])
                boundary = live.pop()
                if boundary > base:
                    commit(_path(back, made, base, boundary))
                    best, back, made = best[boundary - base :], back[boundary - base :], made[boundary - base :]
                    base, wait = boundary, longest
                else:
                    wait *= 2
                ask = end + wait
            end, score, piece = end + 1, LOW, None
        if arc is None:
            break
        found, size, gain = arc
        start = end - size
        if start < base:
            continue
        if not v.merges:
            if best[start - base] + gain > score:
                score, at, piece = best[start - base] + gain, start, found
        elif piece is None:
            before = made[start - base]
            key = (before if type(before) is int else -1) << 32 | found
            follows = v.pairs.get(key)
            if follows is None:
                if len(v.pairs) >= PAIRS:
                    v.pairs.clear()
                follows = v.pairs[key] = v.may_follow(before, found)
            if follows:
                score, at, piece = 0.0, start, found
    if n:
        commit(_path(back, made, base, n))
    return max(held, n - base)


def short(text: str, v: Vocabulary) -> list[int]:
    """What `stream` commits for a text of a merge model that is shorter than its first question and has pieces for all characters.

    Nothing is forgotten in so short a text, so only the survivors are kept.
    """
    n, pairs = len(text), v.pairs
    made, back = [-1] + [None] * n, [0] * (n + 1)
    if len(pairs) >= PAIRS:
        pairs.clear()
    for last, (found, size, _) in v.automaton.iter(text):
        if made[last + 1] is None:
            start = last + 1 - size
            key = made[start] << 32 | found
            follows = pairs.get(key)
            if follows is None:
                follows = pairs[key] = v.may_follow(made[start] if start else None, found)
            if follows:
                made[last + 1], back[last + 1] = found, start
    out = []
    while n:
        out.append(made[n])
        n = back[n]
    return out[::-1]


def _path(back: list[int], made: list, base: int, end: int) -> list[int]:
    out: list[int] = []
    while end > base:
        ids = made[end - base]
        out += reversed(ids) if isinstance(ids, list) else (ids,)
        end = back[end - base]
    return out[::-1]


class Encoder:
    """Encodes texts after a leading space, as the vocabulary's models do.

    Between characters that are side by side in no piece all paths have a boundary. Where every piece has spaces only at its
    beginning, texts are cut before spaces, and around full stops and commas after letters and digits that stand before them in
    no piece. The search is made once for each distinct span that is still remembered.
    """

    _own = re.compile(f"[{STOP}-{BARE}]").search

    def __init__(self, v: Vocabulary, remembered: int = REMEMBERED):
        self.v = v
        self.spaces_begin = not any(" " in p.lstrip(" ") for p in v.known)
        alone = lambda chars: f"[^\\W_{re.escape(''.join(sorted(chars)))}]"
        stop, comma = (alone({a for a, b in v.joined if b == mark}) for mark in ".,")
        letter = alone({b for a, b in v.joined if a == "\n"})
        self._stops, self._commas, self._lines = (re.compile(x).sub for x in (rf"\.(?<={stop}\.) ", rf",(?<={comma},) ", rf"\.(?<={stop}\.)\n(?={letter})"))
        self.words, self.spans = Recent(self.word, remembered * 3 // 8), Recent(self.searched, remembered // 8)
        self.decoded = [v.bytes_of.get(i, b"") for i in range(max(v.bytes_of) + 1)]

    def searched(self, span: str) -> bytes:
        """Packed ids of a span between two boundaries."""
        if self.v.merges and len(span) <= 2 * self.v.longest and self.v.known.keys() >= set(span):
            return array("I", short(span, self.v)).tobytes()
        ids: list[int] = []
        stream(span, self.v, ids.extend)
        return array("I", ids).tobytes()

    def word(self, part: str) -> bytes:
        return self.searched(MARKS[part] if part in MARKS else part[1:] if part[:1] == BARE else " " + part)

    def shrink(self, most: int) -> None:
        """At a task's end: what an idle worker keeps."""
        for known in (self.words, self.spans):
            known.shrink(most // 2)
        if most < self.words.most:
            self.v.pairs.clear()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if not self.spaces_begin:
            return np.frombuffer(self.searched(" " + text), "<u4")
        if "  " in text or text[0] == " " or self._own(text):
            return np.frombuffer(b"".join(map(self.spans.__getitem__, _span(" " + text))), "<u4")
        text = self._lines(f" {LINE} {BARE}", self._commas(f" {COMMA} ", self._stops(f" {STOP} ", text)))
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.split(" "))), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.decoded.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")[1:]


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One for each worker process."""
    if (path, remembered) not in _encoders:
        _encoders.clear()
        _encoders[path, remembered] = Encoder(Vocabulary.read(path), remembered)
    return _encoders[path, remembered]


def encoded(docs: DataFrame, vocabulary: str, with_ids: bool = False, remembered: int = REMEMBERED, kept: int | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), decoded_sha256 and round_trip (and ids).

    Whole texts are encoded and their ids decoded again; round_trip says whether that gives the text. A null text counts as
    empty and has no ids. Repeated rows are each encoded, a null doc_id stays, other columns are ignored, and an empty table
    gives no rows. A literal U+2581 in a text is encoded as bytes, so that it isn't read as a space. remembered: bytes of
    words that a worker keeps while it encodes; kept: those that it keeps after a task, if it goes on with other operators.
    """
    kinds = {"doc_id": pa.int64(), "n_ids": pa.int64(), "ids_crc32": pa.int64(), "decoded_sha256": pa.string(), "round_trip": pa.bool_()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})
    schema = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(vocabulary, remembered)
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                text = text.as_py() or ""
                ids = e.encode(text)
                back = e.decode(ids)
                digest = hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((doc, len(ids), zlib.crc32(ids.tobytes()), digest, back == text, *([ids.view("<i4")] if with_ids else [])))
            yield pa.RecordBatch.from_pydict({c: [r[i] for r in rows] for i, c in enumerate(kinds)}, pa.schema(list(kinds.items())))
        if kept is not None:
            e.shrink(kept)

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, schema)


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, decoded again."""
    import public_tokenizers

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
