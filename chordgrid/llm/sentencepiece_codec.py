"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces.

The driver reads the pieces and scores of a model file and builds the trie; both are of the size of
the vocabulary and go to the tasks as a broadcast. Texts are encoded batch by batch:

* White space: a marker (U+2581) stands for each space, and one more precedes the text. Where no piece
  holds a marker behind another character, the best path of a text is that of its marker-led segments
  one by one, and each distinct segment is segmented once for a task.
* Long segments (Chinese or Japanese text, data without spaces) are cut between two characters that stand
  side by side in no piece, which no path can cross.
* Viterbi: all new segments of a batch advance together, byte by byte, through the trie.
* Byte fallback: a character that no piece covers costs the lowest score less 10 and becomes one byte
  piece for each of its UTF-8 bytes. A marker character in the text itself is always written so, which
  makes decoding exact for every text.

A model whose scores are merge ranks (BPE) has no log scores; its pieces then get those of Zipf's law,
ln p(r) = -ln(r + 1) - ln(sum over all pieces). They are a rule, not fitted to any text: tokenizers are
given, and none is trained here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.llm.shared import fresh
from chordgrid.llm.words import pieces as slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Stand for the three bytes of a marker in the text; these bytes are never in UTF-8.
_LITERAL = b"\xf8\xf9\xfa"
_MARK = MARK.encode()
FALLBACK_PENALTY = 10.0
#: A stored score that low bars a piece.
NEVER = -1e8
#: Bytes that a task's cache of segments may hold beside those of one slice of a batch; then it starts anew.
CACHE_BYTES = 64 << 20
#: What an entry costs besides its segment and its pieces.
ENTRY_BYTES = 200
#: Segments with more bytes are never kept, and are segmented one by one.
LONG_SEGMENT = 96
LONG_CHARS = LONG_SEGMENT // 3


@dataclass
class Vocabulary:
    """Pieces by id, their log scores, and which of them match text."""

    pieces: list[bytes]
    scores: np.ndarray
    matches: np.ndarray
    byte_ids: np.ndarray

    @classmethod
    def read(cls, path: str) -> "Vocabulary":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i).encode() for i in range(n)]
        stored = np.array([model.get_score(i) for i in range(n)])
        byte = np.array([model.is_byte(i) for i in range(n)])
        matches = ~(byte | np.array([model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]))
        ids = np.full(256, -1, np.int32)
        for i in np.flatnonzero(byte):
            ids[int(pieces[i][3:5], 16)] = i
        if (ids < 0).any():
            raise ValueError("the model has no byte pieces")
        if not matches[pieces.index(_MARK)]:
            raise ValueError("the model has no piece for a space alone")
        ids[list(_LITERAL)] = ids[list(_MARK)]
        return cls(pieces, log_scores(stored, matches), matches, ids)


def log_scores(stored: np.ndarray, matches: np.ndarray) -> np.ndarray:
    """The stored scores, or Zipf's law where they are whole ranks 0, -1, -2, ..; pieces that the model
    bars (runs of markers, which no merge makes) come just below all others."""
    usual = matches & (stored > NEVER)
    own, scores = stored[usual], stored
    if len(own) > 1 and (own == np.round(own)).all() and len(np.unique(own)) == len(own):
        scores = -np.log(np.where(usual, -stored, 0) + 1) - np.log((1 / (1 - own)).sum())
    return np.where(matches, np.where(usual, scores, scores[usual].min() - 1), 0.0)


class DoubleArray:
    """A double-array trie over bytes: the child of state s by byte b is base[s] + b if check there is s.

    ``value`` of a state is the id of the piece that ends there, or -1. State 0 is the root; slot
    base + b + 1 is used so that no child falls on it.
    """

    def __init__(self, keys: list[bytes], ids: list[int]):
        order = sorted(range(len(keys)), key=lambda i: keys[i])
        keys, ids = [keys[i] for i in order], [ids[i] for i in order]
        size = 1 << 10
        base, check, value, used = [0] * size, [-1] * size, [-1] * size, bytearray(size)
        used[0] = 1
        # the lowest free slot, where single children go, and the highest used one, near which others go
        # (lower slots than 257 are out of reach for some bytes)
        low, top, queue = 257, 0, [(0, 0, len(keys), 0)]
        for state, a, b, depth in queue:
            if a < b and len(keys[a]) == depth:
                value[state] = ids[a]
                a += 1
            if a == b:
                continue
            labels, cuts = [], []
            at = a
            while at < b:
                label = keys[at][depth]
                labels.append(label)
                cuts.append(at)
                while at < b and keys[at][depth] == label:
                    at += 1
            cuts.append(b)
            while low < len(used) and used[low]:
                low += 1
            start = max(0, low - labels[0] - 1)
            if len(labels) > 1:
                start = max(start, top - 300)
            while True:
                if start + 258 > len(used):
                    more = len(used)
                    base += [0] * more
                    check += [-1] * more
                    value += [-1] * more
                    used += bytearray(more)
                if not any(used[start + x + 1] for x in labels):
                    break
                start += 1
            base[state], top = start, max(top, start + labels[-1] + 1)
            for k, x in enumerate(labels):
                child = start + x + 1
                used[child], check[child] = 1, state
                queue.append((child, cuts[k], cuts[k + 1], depth + 1))
        self.base, self.check, self.value = (np.array(x, np.int32) for x in (base, check, value))


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        known = [int(i) for i in np.flatnonzero(vocabulary.matches)]
        self.trie = DoubleArray([vocabulary.pieces[i] for i in known], known)
        self.longest = max(len(vocabulary.pieces[i]) for i in known)
        self.unknown = float(vocabulary.scores[vocabulary.matches].min()) - FALLBACK_PENALTY
        self.by_segment = not any(MARK in p.lstrip(MARK) for p in (vocabulary.pieces[i].decode() for i in known))
        texts = [p.replace(_MARK, b" ") if m else b"" for p, m in zip(vocabulary.pieces, vocabulary.matches)]
        for byte in range(256):
            if byte not in _LITERAL:
                texts[vocabulary.byte_ids[byte]] = bytes([byte])
        self.texts = texts
        spelled = [vocabulary.pieces[i].decode() for i in known]
        self.neighbours = {p[k : k + 2] for p in spelled for k in range(len(p) - 1)}
        self.is_byte = np.zeros(len(texts), bool)
        self.is_byte[vocabulary.byte_ids] = True

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "cached": 0}

    # -- encoding

    def segments(self, text: str) -> list[str]:
        """The text's segments, each without its first marker; a marker is still a space here."""
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, "\udcf8\udcf9\udcfa")
        if not self.by_segment:
            return [text]
        parts = text.split(" ")
        if "" not in parts:
            return parts
        out, spaces, last = [], "", len(parts) - 1
        for i, part in enumerate(parts):
            if part or i == last:
                out.append(spaces + part)
                spaces = ""
            else:
                spaces += " "
        return out

    def raw(self, segment: str) -> bytes:
        return _MARK + segment.replace(" ", MARK).encode("utf-8", "surrogateescape")

    def units(self, text: str) -> list[str | bytes]:
        """What is segmented by itself: short segments as they are, long ones in their parts, as bytes."""
        parts = self.segments(text)
        if not parts or LONG_CHARS >= len(max(parts, key=len)):
            return parts
        out: list[str | bytes] = []
        for segment in parts:
            if len(segment) > LONG_CHARS:
                whole = MARK + segment.replace(" ", MARK)
                held, start = self.neighbours, 0
                for k in range(1, len(whole)):
                    if whole[k - 1 : k + 1] not in held:
                        out.append(whole[start:k].encode("utf-8", "surrogateescape"))
                        start = k
                out.append(whole[start:].encode("utf-8", "surrogateescape"))
            else:
                out.append(segment)
        return out

    def encode_segments(self, segments: list[str | bytes]) -> list[bytes]:
        """Piece ids of each segment as int32 bytes."""
        raw = [s if isinstance(s, bytes) else self.raw(s) for s in segments]
        short = [i for i, r in enumerate(raw) if len(r) <= LONG_SEGMENT]
        out: list[bytes] = [b""] * len(raw)
        for i, ids in zip(short, self._together([raw[i] for i in short])):
            out[i] = ids
        for i, r in enumerate(raw):
            if len(r) > LONG_SEGMENT:
                out[i] = self._alone(r)
        return out

    def _together(self, raw: list[bytes]) -> list[bytes]:
        """Viterbi over many short segments at once; ties keep the path whose last piece starts first."""
        if not raw:
            return []
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.v.scores
        length = np.array([len(r) for r in raw])
        order = np.argsort(-length, kind="stable")
        length = length[order]
        buffer = np.frombuffer(b"".join(raw[i] for i in order) + b"\0", np.uint8).astype(np.int32)
        start = np.cumsum(length) - length
        slot = start + np.arange(len(raw))  # each segment has length + 1 slots
        best = np.full(int(length.sum()) + len(raw), -np.inf)
        piece, back = np.full(len(best), -1, np.int32), np.zeros(len(best), np.int32)
        best[slot] = 0.0
        lead = (buffer & 0xC0) != 0x80
        wide = np.where(buffer < 0x80, 1, np.where(buffer >= 0xF8, 1, np.where(buffer >= 0xF0, 4, np.where(buffer >= 0xE0, 3, 2))))
        for p in range(int(length[0])):
            live = np.arange(np.searchsorted(-length, -p, "left"))  # segments longer than p
            live = live[lead[start[live] + p]]
            score = best[slot[live] + p]
            here = wide[start[live] + p]
            self._improve(best, piece, back, slot[live] + p + here, score + self.unknown, -1, p)
            state = np.zeros(len(live), np.int32)
            for depth in range(1, self.longest + 1):
                ok = length[live] >= p + depth
                live, state, score = live[ok], state[ok], score[ok]
                if not len(live):
                    break
                child = base[state] + buffer[start[live] + p + depth - 1] + 1
                ok = check[child] == state
                live, state, score = live[ok], child[ok], score[ok]
                if not len(live):
                    break
                ids = value[state]
                end = ids >= 0
                if end.any():
                    self._improve(best, piece, back, slot[live[end]] + p + depth, score[end] + scores[ids[end]], ids[end], p)
        at, live, found = length.copy(), np.arange(len(raw)), []
        step = 0
        while len(live):
            here = slot[live] + at[live]
            found.append((live, np.full(len(live), step), piece[here], back[here], at[live]))
            at[live] = back[here]
            live, step = live[at[live] > 0], step + 1
        seg, step, ids, frm, to = (np.concatenate(x) for x in zip(*found))
        by = np.lexsort((-step, seg))
        seg, ids, frm, to = seg[by], ids[by], frm[by], to[by]
        times = np.where(ids < 0, to - frm, 1)
        seg, frm, ids = np.repeat(seg, times), np.repeat(frm, times), np.repeat(ids, times)
        nth = np.arange(len(seg)) - np.repeat(np.cumsum(times) - times, times)
        fallback = ids < 0
        ids[fallback] = self.v.byte_ids[buffer[start[seg[fallback]] + frm[fallback] + nth[fallback]]]
        cuts = (np.searchsorted(seg, np.arange(len(raw) + 1)) * 4).tolist()
        data, out = ids.astype(np.int32).tobytes(), [b""] * len(raw)
        for k, i in enumerate(order.tolist()):
            out[i] = data[cuts[k] : cuts[k + 1]]
        return out

    @staticmethod
    def _improve(best, piece, back, at, score, ids, p) -> None:
        better = score > best[at]
        at = at[better]
        best[at], piece[at], back[at] = score[better], ids if np.isscalar(ids) else ids[better], p

    def _alone(self, raw: bytes) -> bytes:
        """Viterbi over one long segment."""
        if not hasattr(self, "_lists"):
            self._lists = [x.tolist() for x in (self.trie.base, self.trie.check, self.trie.value, self.v.scores)]
        base, check, value, scores = self._lists
        n, none = len(raw), float("-inf")
        best, piece, back = [none] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for p in range(n):
            score = best[p]
            if score == none:
                continue
            b = raw[p]
            end = p + (1 if b < 0x80 or b >= 0xF8 else 4 if b >= 0xF0 else 3 if b >= 0xE0 else 2)
            if score + self.unknown > best[end]:
                best[end], piece[end], back[end] = score + self.unknown, -1, p
            state = 0
            for q in range(p, min(n, p + self.longest)):
                child = base[state] + raw[q] + 1
                if check[child] != state:
                    break
                state = child
                k = value[state]
                if k >= 0 and score + scores[k] > best[q + 1]:
                    best[q + 1], piece[q + 1], back[q + 1] = score + scores[k], k, p
        out, at = [], n
        while at:
            out.append([piece[at]] if piece[at] >= 0 else [int(self.v.byte_ids[b]) for b in raw[back[at] : at]])
            at = back[at]
        return np.array([i for part in reversed(out) for i in part], np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Piece ids of each text as int32 bytes; none for a null or empty text."""
        cache = self.__dict__.setdefault("cache", {})
        split = [self.units(t or "") for t in texts]
        new = set().union(*split).difference(cache)
        if self.__dict__.get("cached", 0) > CACHE_BYTES:
            cache.clear()
            self.cached, new = 0, set().union(*split)
        listed, long_ = list(new), []
        for a in range(0, len(listed), 50_000):
            some = listed[a : a + 50_000]
            made = self.encode_segments(some)
            cache.update(zip(some, made))
            self.cached = self.__dict__.get("cached", 0) + sum(ENTRY_BYTES + len(s) + len(m) for s, m in zip(some, made))
            long_ += [s for s in some if len(s) > LONG_SEGMENT]
        out = [b"".join([cache[s] for s in parts]) for parts in split]
        for s in long_:  # long segments are hardly ever met again
            self.cached -= ENTRY_BYTES + len(s) + len(cache.pop(s))
        return out

    # -- decoding

    def decode(self, ids: list[int]) -> bytes:
        """The text of piece ids: markers become spaces, the first of them goes, byte pieces become bytes."""
        text = b"".join([self.texts[i] for i in ids])
        return text[1:] if text[:1] == b" " and not self.is_byte[ids[0]] else text


def encode_table(docs: DataFrame, codec: Codec, text_col: str = "text", check: bool = True) -> DataFrame:
    """(row, piece_ids array<int>, n_byte_pieces, decoded): all columns of docs in ``row``, and the text that the
    pieces give again (null without ``check``)."""
    held = docs.sparkSession.sparkContext.broadcast(codec)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held.value
        for piece in slices(batches, "text"):
            ids = codec.encode(piece.column("text").to_pylist())
            flat = np.frombuffer(b"".join(ids), np.int32)
            bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
            byte = np.concatenate([[0], np.cumsum(codec.is_byte[flat])])
            decoded = [codec.decode(np.frombuffer(x, np.int32).tolist()) if x else b"" for x in ids] if check else [None] * len(ids)
            yield pa.record_batch(
                [piece.column("row"), column, pa.array((byte[bounds[1:]] - byte[bounds[:-1]]).astype(np.int64)), pa.array(decoded, pa.binary()).cast(pa.string())],
                ["row", "piece_ids", "n_byte_pieces", "decoded"])

    made = T.StructType([rows.schema["row"], T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_byte_pieces", T.LongType()), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(run, made)


def decode_table(rows: DataFrame, codec: Codec, ids_col: str = "piece_ids", out_col: str = "decoded") -> DataFrame:
    """The rows with the text of their piece ids in ``out_col`` (a null list gives an empty text; the name gets a
    leading underscore where rows have one like it)."""
    (out_col,) = fresh(rows, out_col)
    held = rows.sparkSession.sparkContext.broadcast(codec)
    made = T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [held.value.decode(x) if x else b"" for x in batch.column(ids_col).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names, out_col])

    return rows.mapInArrow(run, made)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per row of docs: doc_id, n_pieces, n_byte_pieces, piece_ids, text_sha256 (of the text that
    the pieces decode to) and same (it is the text).

    A null text is taken as empty and has no pieces; texts of any length are encoded whole; rows that repeat
    are encoded alike. Other columns are not read. An empty table gives an empty result.
    """
    only = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = encode_table(only, Codec(Vocabulary.read(model)))
    return out.select(
        "row.doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "n_byte_pieces", "piece_ids",
        F.sha2("decoded", 256).alias("text_sha256"), (F.col("decoded") == F.col("row.text")).alias("same"))


def with_pieces(docs: DataFrame, text_col: str = "text", ids_col: str = "piece_ids", model: str = MODEL) -> DataFrame:
    """The rows of docs, unchanged, with their piece ids in a new last column (with a leading underscore where
    docs has one of that name). Nulls, long texts, repeats and empty tables as in :func:`encoded`."""
    out = encode_table(docs, Codec(Vocabulary.read(model)), text_col, check=False)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns], F.col("piece_ids").alias(fresh(docs, ids_col)[0]))
