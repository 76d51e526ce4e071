"""SentencePiece BPE encoding by a prefix table, and decoding.

Encoding: for every prefix of a text there is exactly one last token. A token that ends at a
position (found by an Aho-Corasick automaton over the pieces) is that last token when the last
token before it and the token itself are compatible, that is, when merging their joined text
from characters gives just the two back. One pass fills the table, ids are read backwards.
The time is linear in the text whatever the words look like.

No piece of such a model has the space mark behind another character, so no merge crosses the
start of a space run: a text falls into independent segments (space marks, then other
characters) and repeated segments are looked up.

Characters without a piece become byte pieces. Models with other normalisation than the
identity, or with user-defined pieces, are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import pieces, string_bytes
from cellar.operators.ordinal import quoted

MARK = "▁"
#: Piece types of the model format (fixed values): normal, unknown, control, byte.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Remembered segments and pairs per Python worker; the memory is cleared when it is full.
REMEMBERED = 300_000
#: Segments up to this many characters are encoded many at a time and remembered.
TABLE_CHARS = 32
#: Characters the many-at-a-time table knows (the first single-character pieces by code point).
TABLE_ALPHABET = 256


class Model:
    """Pieces, merge priorities and the automaton of a SentencePiece BPE model."""

    def __init__(self, pieces: list[tuple[str, float, int]], dummy_prefix: bool = True):
        self.pieces = pieces
        self.dummy_prefix = dummy_prefix
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.score = {p: s for p, s, kind in pieces if kind == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.hidden = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has the space mark behind another character")
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            # a piece that its own characters do not merge to can never be a token
            if len(p) == 1 or self.merge(p) == [p]:
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.segments: dict[str, tuple[int, str, str]] = {}
        self.table = PrefixTable(self)

    @classmethod
    def load(cls, path: str) -> Model:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if (trainer.model_type != trainer.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or trainer.treat_whitespace_as_suffix or not trainer.byte_fallback
                or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only BPE models with byte pieces and without normalisation are supported")
        return cls([(p.piece, p.score, p.type) for p in proto.pieces], norm.add_dummy_prefix)

    def merge(self, text: str) -> list[str]:
        """Merge characters pair by pair, best score first, leftmost among equals."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (s := self.score.get(joined := parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (-s, a, b, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, joined = heapq.heappop(heap)
            if parts[a] is None or parts[b] is None or right[a] != b or parts[a] + parts[b] != joined:
                continue
            parts[a], parts[b], right[a] = joined, None, right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in parts if p is not None]

    def compatible(self, a: str, b: str) -> bool:
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return known

    def tokens(self, segment: str) -> list[str]:
        """Tokens of a segment from the table of each prefix's last token."""
        last = [""] * (len(segment) + 1)
        # matches come by rising end, for one end the longest first
        for end, piece in self.automaton.iter(segment):
            if not last[end + 1]:
                begin = end + 1 - len(piece)
                if not begin or self.compatible(last[begin] or segment[begin - 1], piece):
                    last[end + 1] = piece
        out, i = [], len(segment)
        while i:
            token = last[i] or segment[i - 1]
            out.append(token)
            i -= len(token)
        return out[::-1]

    def to_ids(self, tokens: list[str]) -> list[int]:
        out = []
        for t in tokens:
            i = self.ids.get(t)
            if i is not None:
                out.append(i)
            else:
                out += [self.bytes[b] for b in t.encode("utf-8")]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids without an end id."""
        return [int(i) for _, s, _ in self.encode_many([text])[0] for i in s.split()]

    def encode_many(self, texts: list[str]) -> list[list[tuple[int, str, str]]]:
        """For every text its segments: number of ids, the ids as text, the ids decoded."""
        known = self.segments
        if len(known) > REMEMBERED:
            known.clear()
        front = MARK if self.dummy_prefix else ""
        split = [_SEGMENT.findall(front + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list({s for segments in split for s in segments}.difference(known))
        plain = [s for s in new if len(s) <= TABLE_CHARS]
        rows = self.table.encode(plain) if plain else []
        for s, ids in zip(plain, rows, strict=True):
            if ids is not None:
                known[s] = (len(ids), " ".join(map(str, ids)), self._segment_text(ids))
        for s in new:
            if s not in known:
                ids = self.to_ids(self.tokens(s))
                known[s] = (len(ids), " ".join(map(str, ids)), self._segment_text(ids))
        out = [[known[s] for s in segments] for segments in split]
        for s in new:
            if len(s) > TABLE_CHARS:
                del known[s]
        return out

    def _segment_text(self, ids: list[int]) -> str:
        """Decoded ids of a segment, the space of its mark included."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.pieces[i][0] for i in ids]).replace(MARK, " ")
        return self.decode(ids, text_start=False)

    def joined(self, segments: list[tuple[int, str, str]]) -> str:
        """Decoded text of the segments of one text. Segments begin with a space mark, so no
        run of byte pieces goes across them."""
        text = "".join([s[2] for s in segments])
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def decode(self, ids: list[int], text_start: bool = True) -> str:
        """Text of ids: byte pieces join to characters (broken ones become U+FFFD each), control
        ids vanish, the space mark is a space, and the space put before a text goes."""
        out: list[str] = []
        run = bytearray()
        first = text_start
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                first = False
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            if i in self.hidden:
                continue
            if i == self.unknown:
                out.append(" ⁇ ")
                first = False
                continue
            piece = self.pieces[i][0]
            if first and self.dummy_prefix and piece.startswith(MARK):
                piece = piece[1:]
            first = False
            out.append(piece.replace(MARK, " "))
        if run:
            out.append(_utf8(run))
        return "".join(out)


class PrefixTable:
    """The prefix table for many short segments at once, as arrays.

    The automaton is a dense table over the first ``TABLE_ALPHABET`` characters that are pieces;
    a segment with another character is left to the caller (``None``).
    """

    def __init__(self, m: Model):
        self.model = m
        chars = sorted(p for p in m.ids if len(p) == 1)
        chars = sorted({MARK, *chars[:TABLE_ALPHABET - 1]} & set(chars))
        self.code = np.full(0x110000, -1, np.int16)
        for i, c in enumerate(chars):
            self.code[ord(c)] = i
        known = set(chars)
        children: list[dict[int, int]] = [{}]
        token = [-1]
        for piece in m.automaton.keys():
            if not known.issuperset(piece):
                continue
            state = 0
            for c in piece:
                c = int(self.code[ord(c)])
                if c not in children[state]:
                    children[state][c] = len(children)
                    children.append({})
                    token.append(-1)
                state = children[state][c]
            token[state] = m.ids[piece]
        n = len(children)
        self.step = np.zeros((n, len(chars)), np.int32)
        self.token = np.array(token, np.int64)
        # nearest state, itself or a suffix of it, that ends a piece; 0: none
        self.ending = np.zeros(n, np.int32)
        self.shorter = np.zeros(n, np.int32)
        fail = [0] * n
        level = [0]
        while level:
            below = []
            for s in level:
                if s:
                    self.step[s] = self.step[fail[s]]
                    self.shorter[s] = self.ending[fail[s]]
                    self.ending[s] = s if token[s] >= 0 else self.shorter[s]
                for c, t in children[s].items():
                    if s:
                        fail[t] = int(self.step[s, c])
                    self.step[s, c] = t
                    below.append(t)
            level = below
        self.length = np.array([len(p) for p, _, _ in m.pieces], np.int64)
        self.pair = np.zeros(0, np.int64)
        self.fits = np.zeros(0, bool)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.length) + b
        at = np.searchsorted(self.pair, key)
        hit = at < len(self.pair)
        hit[hit] = self.pair[at[hit]] == key[hit]
        if not hit.all():
            new = np.unique(key[~hit])
            pieces, merge = self.model.pieces, self.model.merge
            flags = []
            for k in new.tolist():
                x, y = pieces[k // len(self.length)][0], pieces[k % len(self.length)][0]
                flags.append(merge(x + y) == [x, y])
            keys = np.concatenate([self.pair, new])
            order = np.argsort(keys, kind="stable")
            self.pair, self.fits = keys[order], np.concatenate([self.fits, np.array(flags, bool)])[order]
            at = np.searchsorted(self.pair, key)
        return self.fits[at]

    def encode(self, segments: list[str]) -> list[list[int] | None]:
        if len(self.pair) > 10 * REMEMBERED:
            self.pair, self.fits = self.pair[:0], self.fits[:0]
        length = np.array([len(s) for s in segments], np.int64)
        chars = self.code[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        first = np.cumsum(length) - length
        usable = np.minimum.reduceat(chars, first) >= 0
        order = np.flatnonzero(usable)
        order = order[np.argsort(-length[order], kind="stable")]
        size, first = length[order], first[order]
        out: list[list[int] | None] = [None] * len(segments)
        if not len(order):
            return out
        longest = int(size[0])
        last = np.full((len(order), longest + 1), -1, np.int64)
        state = np.zeros(len(order), np.int32)
        for i in range(1, longest + 1):
            live = int(np.searchsorted(-size, -i, side="right"))
            state = self.step[state[:live], chars[first[:live] + i - 1]]
            row, at = np.arange(live), self.ending[state]
            while len(row):
                token = self.token[at]
                begin = i - self.length[token]
                good = begin == 0
                rest = np.flatnonzero(~good)
                good[rest] = self.compatible(last[row[rest], begin[rest]], token[rest])
                last[row[good], i] = token[good]
                row, at = row[~good], self.shorter[at[~good]]
        tokens = np.zeros((len(order), longest), np.int64)
        count, at, row = np.zeros(len(order), np.int64), size.copy(), np.arange(len(order))
        while len(row):
            token = last[row, at[row]]
            tokens[row, count[row]] = token
            count[row] += 1
            at[row] -= self.length[token]
            row = row[at[row] > 0]
        for k, n, ids in zip(order.tolist(), count.tolist(), tokens.tolist(), strict=True):
            out[k] = ids[:n][::-1]
        return out


_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _utf8(run: bytearray) -> str:
    """Characters of a byte run; each byte that is no part of one is U+FFFD."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[i:i + n]).decode("utf-8"))
                    i += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                i += 1
        return "".join(out)


_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of a file, kept by the Python worker."""
    if path not in _MODELS:
        _MODELS[path] = Model.load(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, path: str, text: str = "text", end_id: int | None = 2,
                     keep_ids: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (and ``ids`` on request).

    One map over whole texts, no shuffle. A null text counts as empty and gives the end id
    alone; repeated rows give repeated results; the columns ``keep`` (all by default) stay, but
    for those named like a new one.
    """
    new = ["n_tokens", "ids_sha256", "decoded_sha256"] + (["ids"] if keep_ids else [])
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    src = docs.select(*map(quoted, kept), F.col(text).alias("__text"))
    out = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
                    + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))
    schema = docs.select(*map(quoted, kept)).schema
    for name, kind in zip(new, [T.LongType(), T.StringType(), T.StringType(), T.ArrayType(T.IntegerType())], strict=False):
        schema = schema.add(name, kind)

    def run(batches):
        m = model(path)
        tail = [] if end_id is None else [end_id]
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            n_tokens, shas, decoded, all_ids = [], [], [], []
            for begin, end in pieces(*string_bytes(column)):
                texts = [t or "" for t in column.slice(begin, end - begin).to_pylist()]
                for segments in m.encode_many(texts):
                    ids = " ".join([s[1] for s in segments] + [str(i) for i in tail])
                    n_tokens.append(sum([s[0] for s in segments]) + len(tail))
                    shas.append(hashlib.sha256(ids.encode("ascii")).hexdigest())
                    decoded.append(hashlib.sha256(m.joined(segments).encode("utf-8")).hexdigest())
                    if keep_ids:
                        all_ids.append([int(i) for i in ids.split()])
            got = [pa.array(n_tokens, pa.int64()), pa.array(shas), pa.array(decoded)]
            if keep_ids:
                got.append(pa.array(all_ids, pa.list_(pa.int32())))
            old = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(old + got, [*batch.schema.names[:-1], *out.names])

    return src.mapInArrow(run, schema)
