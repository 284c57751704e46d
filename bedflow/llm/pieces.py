"""SentencePiece encoding and decoding by streaming Viterbi.

Encoding walks over the text once.  For each position it keeps the best piece
that ends there (a backpointer), chosen among the pieces of at most
``max_piece`` signs, so the search needs a window of that length only.
Whenever all surviving backpointer paths run through one boundary, the ids
before it are final and committed: neither ids nor backpointers of a long text
wait for its end.

A unigram file's best path has the largest sum of piece scores.  A BPE file's
scores are merge ranks whose sum means nothing; there a path may only join two
pieces that merging would leave apart (merging the pair's signs, best rank
first, gives just the pair).  With that rule exactly one path reaches each
position, and it is the library's own encoding.

Where no piece has a word mark after another sign, every start of a word is a
boundary on which all paths converge; so is every step between letters and
other signs if no piece joins them.  What lies between is a unit of its own,
and units are remembered per task (bounded).  Signs without a piece fall back to
their bytes' pieces.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedflow.llm.common import map_arrow

MARK = "▁"
#: Units remembered per task: as many recent ones, and as many from before them.
MAX_KNOWN = 400_000
#: Beginnings of units are remembered up to this length.
SHARED = 5
#: Longer units are searched anew each time.
MAX_UNIT = 64
#: Pairs of pieces remembered per task.
MAX_PAIRS = 500_000
#: The unknown sign's score lies this far below the lowest piece's.
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _letter(c: str) -> bool:
    return c.isalnum() and not c.isdecimal()


class Codec:
    """Pieces and scores of a SentencePiece model file."""

    _made: dict = {}

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.by_merges = proto.trainer_spec.model_type == proto.trainer_spec.BPE
        n = model.get_piece_size()
        self.text_of = [model.id_to_piece(i) for i in range(n)]
        self.byte_of = {i: int(self.text_of[i][3:-1], 16) for i in range(n) if model.is_byte(i)}
        byte_id = {b: i for i, b in self.byte_of.items()}
        self.bytes_ids = [byte_id.get(b, model.unk_id()) for b in range(256)]
        self.control = {i for i in range(n) if model.is_control(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
                                             or model.is_unused(i))]
        self.piece = {self.text_of[i]: (i, model.get_score(i)) for i in plain}
        #: Every end of a piece: what a longer piece can still begin before.
        self.tails = {p[-k:] for p in self.piece for k in range(1, len(p) + 1)}
        self.max_piece = max(map(len, self.piece), default=1)
        self.unknown = min((s for _, s in self.piece.values()), default=0.0) - UNKNOWN_PENALTY
        #: One unit; None if pieces span words.  Marks go with the signs after them; letters
        #: and other signs are units of their own if no piece joins the two.
        self.unit = None
        if not any(MARK in p.lstrip(MARK) for p in self.piece):
            joined: set[str] = set()  # letters that some piece joins to other signs: counted as such
            while more := {c for p in self.piece if len({_letter(c) and c not in joined for c in p.lstrip(MARK)}) > 1
                           for c in p if _letter(c) and c not in joined}:
                joined |= more
            letter = f"(?![{re.escape(''.join(sorted(joined)))}])[^\\W\\d_]" if joined else r"[^\W\d_]"
            other = rf"(?!{MARK}|{letter})."
            self.unit = re.compile(rf"{MARK}*(?:(?:{letter})+|(?:{other})+)|{MARK}+", re.S)
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.begun: dict[str, str] = {}
        self.most_kept = 0  # positions held at once by the last search

    @classmethod
    def of(cls, path: str) -> "Codec":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _ids(self, piece: str) -> list[int]:
        found = self.piece.get(piece)
        return [found[0]] if found else [self.bytes_ids[b] for b in piece.encode("utf-8", "surrogatepass")]

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves of a short text: again and again the
        neighbours whose joint piece ranks best, the leftmost of equals."""
        parts, piece = list(text), self.piece
        while len(parts) > 1:
            rank, at = max(((piece[j][1], -i) for i in range(len(parts) - 1)
                            if (j := parts[i] + parts[i + 1]) in piece), default=(0.0, 1))
            if at == 1:
                break
            parts[-at:2 - at] = [parts[-at] + parts[1 - at]]
        return parts

    def _apart(self, left: str, right: str, row: dict | None = None) -> bool:
        """Whether merging leaves ``left`` and ``right`` as they are."""
        if row is None:
            row = self.pairs.setdefault(left, {})
        found = row.get(right)
        if found is None:
            self.n_pairs += 1
            if self.n_pairs >= MAX_PAIRS:
                for kept in self.pairs.values():
                    kept.clear()
                self.n_pairs = 0
            found = row[right] = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def search(self, text: str):
        """Committed lists of ids of one stream of signs, as they become final."""
        longest, step = self.max_piece, self._by_merges if self.by_merges else self._by_score
        score = {0: 0.0}  # of a unigram file: the best sum by position, for the window only
        back: dict[int, int] = {}  # position -> start of its best piece, from the last commit on
        done = 0  # everything before is committed
        last = ""  # the piece that ends there
        self.most_kept = 0
        for end in range(1, len(text) + 1):
            back[end] = step(text, end, done, last, back, score)
            score.pop(end - longest, None)
            if len(back) > self.most_kept:
                self.most_kept = len(back)
            if len(back) >= 2 * longest:
                # the positions that a later piece can still start from, walked back until they meet
                alive = set(range(max(done, end - longest + 1), end + 1))
                while len(alive) > 1 and (top := max(alive)) > done:
                    alive.discard(top)
                    alive.add(back[top])
                at = alive.pop()
                if at > done:
                    last = text[back[at]:at]
                    yield self._walk(text, back, done, at)
                    for p in range(done + 1, at + 1):
                        del back[p]
                    done = at
        if len(text) > done:
            yield self._walk(text, back, done, len(text))

    def short(self, text: str) -> list[int]:
        """``search`` of one unit by merges, in one go: its paths need no
        window.  The piece that ends at a position depends on the signs before
        it only, so units that begin alike share what was found."""
        piece, tails, pairs, known = self.piece, self.tails, self.pairs, self.begun
        size = len(text)
        last = [""]  # the piece that ends at each position
        for e in range(1, size + 1):
            if e <= SHARED and (found := known.get(text[:e])) is not None:
                last.append(found)
                continue
            found = text[e - 1]
            s = e - 2
            while s >= 0 and (right := text[s:e]) in tails:
                if right in piece:
                    row = pairs.get(last[s])
                    apart = None if row is None else row.get(right)
                    if self._apart(last[s], right) if apart is None else apart:
                        found = right
                        break
                s -= 1
            last.append(found)
            if e <= SHARED:
                if len(known) >= MAX_KNOWN:
                    known.clear()
                known[text[:e]] = found
        parts, end = [], size
        while end:
            parts.append(last[end])
            end -= len(last[end])
        parts.reverse()
        try:
            return [piece[p][0] for p in parts]
        except KeyError:
            return [i for p in parts for i in self._ids(p)]

    def _by_merges(self, text, end, done, last, back, score) -> int:
        piece = self.piece
        for s in range(max(done, end - self.max_piece), end - 1):
            right = text[s:end]
            if right in piece and self._apart(text[back[s]:s] if s > done else last, right):
                return s
        return end - 1

    def _by_score(self, text, end, done, last, back, score) -> int:
        piece = self.piece
        best, start = score[end - 1] + self.unknown, end - 1
        for s in range(max(done, end - self.max_piece), end):
            found = piece.get(text[s:end])
            # of equal sums the piece that starts first wins
            if found is not None and (score[s] + found[1] > best or (score[s] + found[1] == best and s < start)):
                best, start = score[s] + found[1], s
        score[end] = best
        return start

    def _walk(self, text: str, back: dict[int, int], first: int, last: int) -> list[int]:
        parts = []
        while last > first:
            parts.append(text[back[last]:last])
            last = back[last]
        return [i for p in reversed(parts) for i in self._ids(p)]

    def encode(self, text: str) -> list[int]:
        """Ids of ``text``; a blank is put before it and blanks become word
        marks, as the library does.  An empty text has no ids."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if self.unit is None:
            return [i for part in self.search(marked) for i in part]
        out: list[int] = []
        known, add = self.known, self._unit_ids
        for unit in self.unit.findall(marked):
            out += known.get(unit) or add(unit)
        return out

    def _unit_ids(self, unit: str) -> list[int]:
        """Ids of a unit that is not among the recent ones."""
        ids = self.older.get(unit)
        if ids is None:
            if self.by_merges and len(unit) <= MAX_UNIT:
                ids = self.short(unit)
            else:
                ids = [i for part in self.search(unit) for i in part]
        if len(unit) <= MAX_UNIT:
            self.known[unit] = ids
            if len(self.known) >= MAX_KNOWN:
                # the recent ones become the older ones; the same dict goes on being the recent ones
                self.older = dict(self.known)
                self.known.clear()
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``.  Byte pieces are joined to signs, bytes that form
        none become U+FFFD; control ids have no text."""
        out: list[str] = []
        text_of, byte_of = self.text_of, self.byte_of
        pending = bytearray()
        for i in ids:
            if i in byte_of:
                pending.append(byte_of[i])
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            if i not in self.control:
                out.append(text_of[i])
        out.append(pending.decode("utf-8", "replace"))
        joined = "".join(out).replace(MARK, " ")
        return joined[1:] if joined.startswith(" ") else joined


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids) for every row of (doc_id, text).  Null texts count as
    empty and have no ids; repeated rows repeat; other columns are ignored."""
    path = model or default_model()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        codec = Codec.of(path)
        ids = [np.array(codec.encode(t or ""), np.int32) for t in b.column(1).to_pylist()]
        return pa.record_batch([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch,
                     "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) for every row of (doc_id, ids); null ids give an empty text."""
    path = model or default_model()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        codec = Codec.of(path)
        texts = [codec.decode(x or []) for x in b.column(1).to_pylist()]
        return pa.record_batch([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return map_arrow(encoded.select("doc_id", "ids"), batch, "doc_id long, text string")


def digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_ids, ids_crc32 (little-endian unsigned
    32-bit ids), decoded_chars, decoded_crc32 (UTF-8), round_trip (whether the
    decoded text is the source; a literal word mark comes back as a blank).
    One pass encodes and decodes; ids never leave the task."""
    path = model or default_model()
    names = ["doc_id", "n_ids", "ids_crc32", "decoded_chars", "decoded_crc32", "round_trip"]

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        codec = Codec.of(path)
        rows = []
        for text in b.column(1).to_pylist():
            ids = codec.encode(text or "")
            back = codec.decode(ids)
            rows.append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), len(back),
                         zlib.crc32(back.encode()), back == (text or "")))
        cols = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.bool_()]
        return pa.record_batch([b.column(0), *[pa.array(list(c), k) for c, k in zip(cols, kinds)]], names=names)
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch,
                     "doc_id long, n_ids long, ids_crc32 long, decoded_chars long, decoded_crc32 long, "
                     "round_trip boolean")
