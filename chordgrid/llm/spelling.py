"""Groups of spelling variants by blocked Gram matrices of letter counts.

* *Words.* Runs of letters are counted over all documents; tasks send distinct words with their counts.
* *Blocks.* A block holds the words of one length with equal numbers of letters from each of six classes. One edit
  changes one of these numbers by one (an insertion) or two of them by one each (a replacement between
  classes), so a block meets itself, the blocks of its length that a replacement leads to, and six of the next
  length. Large blocks are dealt to tiles of about ``TILE`` words.
* *Gram matrices.* For two tiles A and B of letter counts, |a|^2 + |b|^2 - 2 A B^T has the squared distances of all
  pairs from one matrix product. An edit changes it by 1 or 2; pairs at most two are kept, never all pairs.
* *Edits.* What is kept is verified letter by letter.

All letters are below U+0100, so a word is one byte a letter in tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chordgrid.llm.shared import fresh, shuffle_width, sized_hint, work_folder, written
from chordgrid.llm.words import LOWER, Words, pieces, text_bytes

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: A form is at least so many times as frequent.
FORM_TIMES = 2
#: Of about so many words one loses a letter.
SPOIL = 97
CLASSES = 6
TILE = 512
#: Letters of a tile, about, where words are long.
TILE_LETTERS = 1 << 20
#: Pairs of words that one task compares, about; a pair of tiles costs as much as so many pairs of words besides.
TASK_PAIRS = 1 << 28
TILE_COST = 20_000
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
#: Distinct words that a task holds before it hands them on.
FLUSH = 400_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = True
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)
#: Words up to so many bytes are hashed together.
_SHORT = 64


# -- words

def letter_runs(texts: pa.Array) -> Words:
    """The runs of letters: A-Z, a-z and U+00C0 to U+00FF, which are the byte C3 and one more."""
    data, bounds = text_bytes(texts)
    kind = data.copy()
    kind[1:][data[:-1] == 0xC3] = 0x61
    runs = Words(kind, bounds, _LETTER)
    runs.data = LOWER[data]
    return runs


def crc_of(runs: Words, ids: list) -> np.ndarray:
    """crc32 of ``<id>:<run>`` for each run; a null id is empty."""
    head = np.array([zlib.crc32(f"{'' if x is None else x}:".encode()) for x in ids], np.uint32)[runs.row]
    state = ~head
    size = runs.end - runs.start
    left = np.flatnonzero(size <= _SHORT)
    for k in range(_SHORT):
        left = left[size[left] > k]
        if not len(left):
            break
        state[left] = _CRC[(state[left] ^ runs.data[runs.start[left] + k]) & np.uint32(255)] ^ (state[left] >> np.uint32(8))
    out = ~state
    for i in np.flatnonzero(size > _SHORT).tolist():
        out[i] = zlib.crc32(runs.data[runs.start[i] : runs.end[i]].tobytes(), int(head[i]))
    return out


def batch_words(piece: pa.RecordBatch, spoil: int) -> pa.Table:
    """(word, n) of the distinct words of some rows (id, text)."""
    runs = letter_runs(piece.column("text"))
    size = runs.end - runs.start
    wide = np.append(0, np.cumsum(runs.data == 0xC3))
    letters = size - (wide[runs.end] - wide[runs.start])
    long = np.flatnonzero(letters >= LEAST_LETTERS)
    made = []
    if spoil and len(long):
        crc = crc_of(runs, piece.column("id").to_pylist())
        hit = crc[long] % np.uint32(spoil) == 0
        for i in long[hit].tolist():
            word = runs.data[runs.start[i] : runs.end[i]].tobytes().decode()
            at = int(crc[i]) % len(word)
            if len(word) > LEAST_LETTERS:
                made.append(word[:at] + word[at + 1 :])
        long = long[~hit]
    _, first, n = np.unique(runs.hashes()[long], return_index=True, return_counts=True)
    at = long[first]
    length = (runs.end - runs.start)[at]
    ends = np.append(0, np.cumsum(length))
    place = np.repeat(runs.start[at] - ends[:-1], length) + np.arange(ends[-1])
    words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(runs.data[place])).cast(pa.string())
    words, n = pa.concat_arrays([words, pa.array(made, pa.string())]), np.append(n, np.ones(len(made), np.int64))
    return pa.table({"word": words, "n": pa.array(n.astype(np.int64))})


def word_counts(batches: Iterator[pa.RecordBatch], spoil: int) -> Iterator[pa.RecordBatch]:
    """Distinct words of a task with their counts, handed on whenever many are held."""
    held, size = [], 0
    add = lambda: pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
    for piece in pieces(batches, "text", 8 << 20):
        held.append(batch_words(piece, spoil))
        size += len(held[-1])
        if size >= FLUSH:
            held = [add()]
            size = len(held[0])
            if size >= FLUSH // 2:
                yield from held[0].to_batches(65_536)
                held, size = [], 0
    if size:
        yield from add().to_batches(65_536)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spoil: int = 0) -> DataFrame:
    """(word, n): lower-cased runs of at least five letters and their occurrences over all documents, three at least.

    ``spoil``: of a document's runs, those whose crc32 of ``<id>:<run>`` it divides lose one letter (0: none).
    """
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = texts.mapInArrow(lambda b: word_counts(b, spoil), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# -- pairs

def class_counts(word: Column) -> list[Column]:
    """How many of a word's letters are in each class (code point modulo CLASSES)."""
    members = ["".join(c for c in LETTERS if ord(c) % CLASSES == k) for k in range(CLASSES)]
    return [F.length(word) - F.length(F.translate(word, m, "")) for m in members]


def neighbour_blocks(block: str = "block") -> Column:
    """A block's own counts, those after it that a replacement leads to, and those that an insertion leads to."""
    step = lambda **d: F.array(*[F.element_at(block, k + 1) + d.get(f"c{k}", 0) for k in range(CLASSES)])
    same = [step(**{f"c{i}": -1, f"c{j}": 1}) for i in range(CLASSES) for j in range(CLASSES) if i != j]
    more = [step(**{f"c{i}": 1}) for i in range(CLASSES)]
    return F.concat(F.filter(F.array(F.col(block), *same), lambda x: x >= F.col(block)), F.array(*more))


def letters_of(joined: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(one row of letters for each of n words of one length, their counts of each letter)."""
    rows = np.frombuffer(joined.encode("latin-1"), np.uint8).reshape(n, -1)
    wide = np.float32 if rows.shape[1] <= 2000 else np.float64  # squares stay exact
    counts = np.bincount((rows + 256 * np.arange(n)[:, None]).ravel(), minlength=256 * n)
    return rows, counts.reshape(n, 256)[:, _USED].astype(wide)


_USED = np.frombuffer(LETTERS.encode("latin-1"), np.uint8)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row, is b one replacement, or one insertion, away from a? b is as long or one longer."""
    size = a.shape[1]
    if b.shape[1] == size:
        return (a != b).sum(1) == 1
    front, back = a != b[:, :size], (a != b[:, 1:])[:, ::-1]
    same = lambda x: np.where(x.any(1), x.argmax(1), size)
    return same(front) + same(back) >= size


def near_pairs(a_rows: tuple[np.ndarray, np.ndarray], b_rows: tuple[np.ndarray, np.ndarray], own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the pairs of two tiles that are one edit apart; of one tile with itself, i < j."""
    (a, x), (b, y) = a_rows, b_rows
    squares = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero((squares <= 2) & (squares >= 1))
    if own:
        i, j = i[i < j], j[i < j]
    step = max(1, (1 << 24) // max(1, b.shape[1]))
    ok = [one_edit(a[i[k : k + step]], b[j[k : k + step]]) for k in range(0, len(i), step)]
    ok = np.concatenate(ok) if ok else np.zeros(0, bool)
    return i[ok], j[ok]


def tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (own, a, n_a, b, n_b), two tiles as joined words and their counts: (word, near, near_n) of each pair, both ways."""
    for batch in batches:
        out: tuple[list, list, list] = ([], [], [])
        for own, a, na, b, nb in zip(*(batch.column(c) for c in ("own", "a", "n_a", "b", "n_b"))):
            na, nb = np.asarray(na.values), np.asarray(nb.values)
            x, y = letters_of(a.as_py(), len(na)), letters_of(b.as_py(), len(nb))
            i, j = near_pairs(x, y, own.as_py())
            if len(i):
                one, two = ([t[k * w : k * w + w] for k in at.tolist()] for t, w, at in ((a.as_py(), x[0].shape[1], i), (b.as_py(), y[0].shape[1], j)))
                for column, values in zip(out, (one + two, two + one, np.append(nb[j], na[i]).tolist())):
                    column.extend(values)
        yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], ["word", "near", "near_n"])


def variants(words: DataFrame, folder: str) -> DataFrame:
    """(word, near, near_n): all pairs of the words (word, n) that are one edit apart, both ways."""
    words = words.withColumn("block", F.array(*class_counts(F.col("word"))))
    sizes = words.groupBy("block").agg(F.count("*").alias("count"), F.sum(F.length("word")).alias("letters"))
    sizes = sizes.select("block", F.greatest(F.ceil(F.col("count") / TILE), F.ceil(F.col("letters") / TILE_LETTERS)).alias("tiles"))
    sizes = written(sizes, folder, "blocks")
    dealt = words.join(sizes.hint(sized_hint(sizes)), "block").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")))
    held = dealt.groupBy("block", "tile").agg(F.collect_list(F.struct("word", "n")).alias("w"))
    name = F.concat(F.array_join(F.col("block").cast("array<string>"), ","), F.lit(":"), F.col("tile"))
    tiles = held.select(name.alias("name"), "block", "tile", F.array_join("w.word", "").alias("letters"), F.col("w.n").alias("counts"))
    tiles = written(tiles, folder, "tiles")
    size = F.size("counts").cast("long")
    left = tiles.select("block", F.col("name").alias("first"), "tile", size.alias("size"), F.explode(neighbour_blocks()).alias("next"))
    right = tiles.select(F.col("block").alias("next"), F.col("name").alias("second"), F.col("tile").alias("b_tile"), size.alias("b_size"))
    pairs = left.join(right.hint("merge"), "next").where((F.col("block") != F.col("next")) | (F.col("tile") <= F.col("b_tile")))
    pairs = written(pairs.select("first", "second", "size", "b_size"), folder, "tile_pairs")
    work = pairs.agg(F.sum(F.col("size") * F.col("b_size") + TILE_COST)).first()[0] or 0
    tasks = max(shuffle_width(words.sparkSession), -(-work // TASK_PAIRS))
    a = tiles.select(F.col("name").alias("first"), F.col("letters").alias("a"), F.col("counts").alias("n_a"))
    b = tiles.select(F.col("name").alias("second"), F.col("letters").alias("b"), F.col("counts").alias("n_b"))
    both = pairs.select("first", "second").join(a.hint("merge"), "first").repartition(tasks, "second").join(b.repartition(tasks, "second").hint("merge"), "second")
    both = both.select((F.col("first") == F.col("second")).alias("own"), "a", "n_a", "b", "n_b")
    return both.mapInArrow(tile_pairs, "word string, near string, near_n long")


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) of (word, form): where forms lead to. Each step doubles the way; forms are ever more frequent,
    so ways are short and without circles."""
    at, step = written(forms.select("word", F.col("form").alias("root")), folder, "roots0"), 0
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = at.join(onward.hint(sized_hint(at)), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step += 1
        found = written(found, folder, f"roots{step}")
        at = found.select("word", "root")
        if found.where("moved").isEmpty():
            return at


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spoil: int = 0, folder: str | None = None) -> DataFrame:
    """One row for each word: word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word (ties: the first in code-point order) if that is at least twice
    as frequent; its root is where forms lead to. Null and empty texts have no words, texts and runs of any length
    count whole, repeated rows count each; a null id is an empty one. Other columns are not read. An empty table
    gives an empty result.
    """
    folder = folder or work_folder(docs.sparkSession)
    words = written(vocabulary(docs, id_col, text_col, spoil), folder, "words")
    near = variants(words, folder).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    near = written(near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")), folder, "near")
    enough = F.col("form_n") >= FORM_TIMES * F.col("n")
    out = words.join(near.hint("merge"), "word", "left")
    out = out.select("word", F.when(enough, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("form_n")).alias("form_n"))
    out = written(out, folder, "forms")
    ends = roots(out.where("form is not null"), folder)
    return out.join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def with_spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: DataFrame | None = None) -> DataFrame:
    """The rows of docs with ``variants``: the distinct words of the text that have another root, as (word, root) in
    order. An existing column of that name stays; a null text has none."""
    groups = groups if groups is not None else spelling_groups(docs, id_col, text_col)
    changed = groups.where("root <> word").select("word", "root")
    key, out = fresh(docs, "_row", "variants")
    rows = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col)))
    runs = F.expr(r"regexp_extract_all(_t, '[A-Za-z\\u00C0-\\u00FF]+', 0)")
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    each = rows.select(F.col(id_col).alias("_i"), F.col(key).alias("_k"), lower.alias("_t")).select("_i", "_k", F.explode(F.array_distinct(runs)).alias("word")).distinct()
    found = each.join(changed.hint("merge"), "word").groupBy("_i", "_k").agg(F.array_sort(F.collect_list(F.struct("word", "root"))).alias(out))
    same = rows[id_col].eqNullSafe(found["_i"]) & (rows[key] == found["_k"])
    return rows.join(found.hint("merge"), same, "left").select(*[rows[c] for c in docs.columns], F.coalesce(F.col(out), F.array().cast("array<struct<word:string,root:string>>")).alias(out))
