"""SentencePiece encoding and decoding, with an exact backtracking encoder.

A merge-type (BPE) model starts from characters and always joins the adjacent pair whose joined
piece scores highest. The encoder here finds the same pieces without that loop: Aho-Corasick
gives the longest piece at each position, pieces are taken from left to right, and a piece is
accepted when it is *compatible* with the one before it, that is, when re-merging the two
pieces' text gives those two pieces back. That is found without merging: both pieces are taken apart
again, the later merge first, and no pair across their border may have come before the merge just
undone. A sequence in which all neighbours are compatible is the merge result. Where no piece fits,
the position is marked as failed and the encoder steps back to a shorter piece.

The text is cut first where no piece can span the cut (before a space marker that follows
another character, and around characters outside the vocabulary, which become byte pieces), so
a worker encodes each distinct chunk once and keeps the result in a bounded cache.

Runs of space markers are the one place where several pieces share a score; those are merged
directly, leftmost first.

Defined cases: a null text counts as empty; the empty text has the end id only; extra columns
are passed on untouched, except that the output columns replace columns of the same names; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from itertools import chain, pairwise

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
CACHE_CHUNKS = 160_000  # chunks of one of the two generations a worker remembers: about 40 MB
CACHE_PAIRS = 400_000  # neighbours whose check a worker remembers: about 45 MB
SHORT = 40  # characters up to which a list of scores is faster than a heap
CACHE_CHARS = 64  # longer chunks are not remembered


class PieceModel:
    """Pieces, scores and byte pieces of a merge-type model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.end_id, self.unk_id = sp.eos_id(), sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(len(self.pieces))]
        self.special = {i for i, x in enumerate(special) if x}
        self.byte_ids = {int(p[1:-1], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.id_byte = {i: b for b, i in self.byte_ids.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in self.special and i not in self.id_byte}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte pieces")
        self._cuts()
        self._trie()
        self.pairs: dict[int, bool] = {}
        self.cache: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.runs: dict[int, list[int]] = {}
        self.raw = [b"" if i in self.special else bytes([self.id_byte[i]]) if i in self.id_byte else p.encode()
                    for i, p in enumerate(self.pieces)]
        if self.unk_id in self.special:
            self.raw[self.unk_id] = " ⁇ ".encode()

    def _cuts(self) -> None:
        """Check what the chunking relies on, and find the characters that pieces join."""
        words = [p for p in self.ids if p.strip(SPACE)]
        tied = len(words) - len({self.score[p] for p in words})
        if tied or any(SPACE in p.lstrip(SPACE) or p.startswith(SPACE * 2) for p in words):
            raise ValueError("pieces with equal scores, or with inner spaces, are not supported")
        joined = {c for p in words if len(p) > 1 for c in p} | {SPACE}
        if not joined <= self.ids.keys():
            raise ValueError("characters that are no piece of their own are not supported")
        inside = "".join(re.escape(c) for c in sorted(joined - {SPACE}))
        # a run of spaces with the word that follows, or one character that nothing joins
        self.chunk = re.compile(f"{SPACE}+[{inside}]*|[{inside}]+|(?s:.)")

    def _trie(self) -> None:
        """Pieces that the merge loop can produce, and for each the longest shorter one."""
        words = [p for p in self.ids if p.strip(SPACE) or p == SPACE]
        made = [p for p in words if self.merge(p) == [p]]
        known = set(made)
        self.found = ahocorasick.Automaton()
        self.shorter: dict[int, int] = {}
        self.size = {self.ids[p]: len(p) for p in made}
        for p in made:
            self.found.add_word(p, (self.ids[p], len(p) - 1))
            for n in range(len(p) - 1, 0, -1):
                if p[:n] in known:
                    self.shorter[self.ids[p]] = self.ids[p[:n]]
                    break
        self.found.make_automaton()
        # the merge that makes a piece: its score, and its two parts (none of a character)
        self.made = {self.ids[p]: (self.score[p], *self.last_merge(p)) for p in made}

    def last_merge(self, piece: str) -> tuple[int | None, int | None]:
        parts, score, never = list(piece), self.score.get, -math.inf
        while len(parts) > 2:
            pairs = [score(a + b, never) for a, b in pairwise(parts)]
            i = pairs.index(max(pairs))
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return (self.ids[parts[0]], self.ids[parts[1]]) if len(parts) == 2 else (None, None)

    def merge(self, text: str) -> list[str]:
        """The plain merge loop: join the pair of the highest score, the leftmost of equals."""
        if len(text) <= SHORT:
            return self.merge_short(text)
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < len(parts):
                both = parts[i] + parts[after[i]]
                if both in self.score:
                    heapq.heappush(heap, (-self.score[both], i, both))
        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != both:
                continue
            j = after[i]
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def merge_short(self, text: str) -> list[str]:
        """The same loop without a heap: the scores of all pairs stand in a list."""
        parts, score, never = list(text), self.score.get, -math.inf
        pairs = [score(a + b, never) for a, b in pairwise(parts)]
        while pairs:
            best = max(pairs)
            if best == never:
                break
            i = pairs.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], never)
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], never)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces come out again when their joined text is merged."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        fits = self.pairs[left << 32 | right] = self.kept_apart(left, right)
        return fits

    def kept_apart(self, left: int, right: int) -> bool:
        """Undo the merges of both pieces, the latest first (of equal ones the right one, since the leftmost is made
        first): a pair across the border that joins earlier than the merge just undone takes a part away from it."""
        pieces, score, made = self.pieces, self.score.get, self.made
        undone = never = -math.inf
        a, b, (score_a, _, inner_a), (score_b, inner_b, _) = left, right, made[left], made[right]
        first = False  # whether the pair across the border goes first where its score is that of the merge undone
        while True:
            across = score(pieces[a] + pieces[b], never)
            if across > undone or (first and across == undone):
                return False
            if inner_a is not None and (inner_b is None or score_a < score_b):
                a, undone, first = inner_a, score_a, False
                score_a, _, inner_a = made[a]
            elif inner_b is not None:
                b, undone, first = inner_b, score_b, True
                score_b, inner_b, _ = made[b]
            else:
                return True

    def backtrack(self, word: str) -> list[int]:
        """Piece ids of a chunk whose characters are all in the vocabulary."""
        n, size, shorter, pairs = len(word), self.size, self.shorter, self.pairs
        longest = [0] * n
        for end, (piece, before) in self.found.iter(word):
            longest[end - before] = piece  # later matches of a start are longer
        failed = bytearray(n + 1)
        taken: list[int] = []
        at = 0
        piece: int | None = longest[0]
        last = -1  # the piece taken before, none at first
        while at < n:
            while piece is not None:
                end = at + size[piece]
                if not failed[end]:
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | piece)
                    if self.compatible(last, piece) if fits is None else fits:
                        break
                piece = shorter.get(piece)
            if piece is not None:
                taken.append(piece)
                last, at = piece, end
                piece = longest[at] if at < n else None
                continue
            failed[at] = 1
            if not taken:
                raise ValueError("no encoding")
            piece = taken.pop()
            at -= size[piece]
            piece = shorter.get(piece)
            last = taken[-1] if taken else -1
        return taken

    def space_run(self, n: int) -> list[int]:
        if n not in self.runs:
            ids = [self.ids[p] for p in self.merge(SPACE * n)]
            if n > 4096:
                return ids
            self.runs[n] = ids
        return self.runs[n]

    def chunk_ids(self, chunk: str) -> list[int]:
        word = chunk.lstrip(SPACE)
        spaces = len(chunk) - len(word)
        if len(word) == 1 and not spaces and word not in self.ids:
            return [self.byte_ids[b] for b in word.encode("utf-8", "replace")]
        if not word:
            return self.space_run(spaces)
        if not spaces:
            return self.backtrack(word)
        ids = self.backtrack(SPACE + word)
        if ids[0] == self.ids[SPACE]:  # no piece joins the last space to the word: it stays in the run
            return self.space_run(spaces) + ids[1:]
        return self.space_run(spaces - 1) + ids if spaces > 1 else ids

    def encode(self, text: str) -> list[int]:
        """Piece ids of a whole text, without the end id."""
        if not text:
            return []
        chunks = self.chunk.findall(SPACE + text.replace(" ", SPACE))
        parts = list(map(self.cache.get, chunks))
        if None in parts:
            for i, ids in enumerate(parts):
                if ids is None:
                    parts[i] = self.remembered(chunks[i])
        return list(chain.from_iterable(parts))

    def remembered(self, chunk: str) -> list[int]:
        """Ids of a chunk, through the cache: when the younger generation is full, it becomes
        the older one, and chunks that are met again move back."""
        ids = self.cache.get(chunk)
        if ids is None:
            ids = self.older.get(chunk)
            if ids is None:
                ids = self.chunk_ids(chunk)
            if len(chunk) <= CACHE_CHARS:
                if len(self.cache) >= CACHE_CHUNKS:
                    self.older, self.cache = self.cache, {}
                self.cache[chunk] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of a sequence: bytes of runs of byte pieces become characters, a byte that is not
        UTF-8 becomes U+FFFD, control pieces vanish, and the space put before the text goes."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            text = self.decode_runs(ids)
        if text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")

    def decode_runs(self, ids: list[int]) -> str:
        """Text of a sequence with bytes that are not UTF-8: each run of byte pieces is read on its own."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.id_byte:
                run.append(self.id_byte[i])
                continue
            if run:
                out.append(utf8_text(bytes(run)))
                run.clear()
            out.append(self.raw[i].decode("utf-8"))
        return "".join(out) + utf8_text(bytes(run))


def utf8_text(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that is not part of a character."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError as e:
        return raw[:e.start].decode("utf-8") + "�" + utf8_text(raw[e.start + 1:])


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, loaded once for each Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "piece_ids",
                  decoded_col: str = "decoded_text") -> DataFrame:
    """``docs`` with the piece ids of each whole text (with the end id) and the text decoded from
    them. One pass over the rows; nothing is shuffled."""
    plain = docs.drop(ids_col, decoded_col)
    schema = T.StructType([*plain.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType())),
                           T.StructField(decoded_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = model(model_path)
        for batch in batches:
            rows = max(1, min(batch.num_rows, 512))
            for at in range(0, batch.num_rows, rows):  # small batches bound the ids held at once
                b = batch.slice(at, rows)
                ids = [codec.encode(x.as_py() or "") + [codec.end_id] for x in b.column(text_col)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(ids, pa.list_(pa.int32())), pa.array([codec.decode(x) for x in ids], pa.string())],
                    names=[*b.schema.names, ids_col, decoded_col])
    return plain.mapInArrow(run, schema)


def digests(ids_col: str = "piece_ids", decoded_col: str = "decoded_text") -> list[Column]:
    """Columns n_tokens, ids_sha256 and decoded_sha256 of an encoded table."""
    return [F.size(ids_col).cast("long").alias("n_tokens"),
            F.sha2(F.concat_ws(" ", F.col(ids_col).cast("array<string>")), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded_col), 256).alias("decoded_sha256")]
