"""Personal data replaced by keyed, type-consistent surrogates.

Detection finds e-mail addresses, phone, card and account numbers, IP addresses, secrets and titled
names. Every distinct entity of the corpus (its normal form, so that spellings of one entity meet) gets
one surrogate from a keyed hash, of its own type, script, gender and format. Surrogates are checked
across the corpus: two entities never share one and none equals a real entity of its type; whoever
loses a collision draws again. Mentions then take their entity's surrogate in their own layout, so one
entity stays one and two stay two. A name that a title gave away is also found where the same document
repeats it without one. A given name is one entity, with the gender that its titles say most often over
the whole corpus (a tie or silence: the lists below, else a neutral name), whatever title stands before it.

The key is the caller's or the session's (``chordgrid.surrogates.key``): who has it can draw the same
surrogates again, and nobody else.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.llm.shared import fresh, work_folder, written
from chordgrid.llm.words import pieces

#: The session setting that holds the key.
KEY_SETTING = "chordgrid.surrogates.key"

#: Titles that tell a name's gender, and neutral ones.
TITLES = {"Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Dr": "n", "Prof": "n", "Г-н": "m", "Г-жа": "f", "Pan": "m", "Pani": "f", "Paní": "f", "Κύριος": "m", "Κυρία": "f", "Господин": "m", "Госпожа": "f"}
#: Given names that tell a gender where the title does not.
FEMALE = "Maria Mary Anna Anne Elena Laura Julia Sophie Emma Carmen Lucia Claire Petra Olga Irina".split()
MALE = "John James Peter Paul Thomas Michael Hans Karl Pierre Jean Juan Carlos Ivan Sergei Luis".split()
KNOWN = {*FEMALE, *MALE}
#: Syllables of made-up names.
SYLLABLES = {"latin": "ba be bo da del do fa fen ga gor ha hel ka kel la lin lo ma mer mo na nel no pa ra rin ro sa sel ta tor va vel za".split(), "cyrillic": "ба бе бо да де до ва вел га го ка ко ла ле ло ма ме мо на не но па ра ри ро са се та то".split(), "greek": "βα γα δε δο κα κο λα λε μα με νι νο πα πε ρα ρο σα σε τα το".split()}
ENDINGS = {("latin", "f"): "a ia ina elle".split(), ("latin", "m"): "n r s do".split(), ("latin", "n"): "en in er is".split(), ("cyrillic", "f"): "а ия ина".split(), ("cyrillic", "m"): "н р в".split(), ("cyrillic", "n"): "ен ин ер".split(), ("greek", "f"): "α η ια".split(), ("greek", "m"): "ος ης ων".split(), ("greek", "n"): "ι ιν".split()}
#: Letters that stand for letters of a script, each in place of any of its range; others become ASCII ones.
ALPHABETS = [
    (0x0370, 0x03FF, "αβγδεζηθικλμνξοπρστυφχψω"), (0x0400, 0x04FF, "абвгдежзиклмнопрстуфхцчшэюя"), (0x0590, 0x05FF, "אבגדהוזחטיכלמנסעפצקרשת"), (0x0600, 0x06FF, "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    (0x3040, 0x309F, "あいうえおかきくけこさしすせそたちつてと"), (0x30A0, 0x30FF, "アイウエオカキクケコサシスセソタチツテト"), (0x4E00, 0x9FFF, "天地人山川日月水火木金土大小中上下"), (0xAC00, 0xD7A3, "가나다라마바사아자차카타파하"),
]
#: Capital letters of Latin, Greek and Cyrillic.
CAPITALS = "".join(c for a, b in ((0x41, 0x250), (0x370, 0x530), (0x1E00, 0x2000)) for c in map(chr, range(a, b)) if c.isupper())

_EMAIL = re.compile(r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)+")
_SECRET = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|(?:sk|pk|ghp|AKIA|xox[bp])[-_]?[0-9A-Za-z_-]{16,})(?![0-9A-Za-z])")
_ASSIGNED = re.compile(r"""(?i)\b(?:token|secret|password|passwd|api[_-]?key)\s*[=:]\s*["']([^"'\s]{6,})["']""")
_IP = re.compile(r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d]|\.\d)")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_CARD = re.compile(r"(?<![\d.+-])\d(?:[ -]{0,2}\d){12,18}(?![\d.-]?\d)")
_PHONE = re.compile(r"(?<![\w.+])(?:\+\d{1,3}[ .-]{0,3})?(?:\(\d{2,4}\)|\d{2,4})[ .-]{1,3}\d{3,4}[ .-]{0,3}\d{3,4}(?:[ .-]{1,3}\d{2,4})?(?![\w-]|\.\d)|(?<!\w)\+\d{8,15}(?!\d)")
_NAME = re.compile(r"(?<!\w)(" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\.?[ \u00a0]([" + CAPITALS + r"][\w'’-]+(?:[ \u00a0][" + CAPITALS + r"][\w'’-]+)?)")
_CAPITAL = re.compile(r"(?<![\w'’-])[" + CAPITALS + r"][\w'’-]+")
_DIGIT = re.compile(r"\d")


def detect(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, type, normal form, gender) of the entities of a text, in order, not overlapping. Names come
    as ``given`` and ``family``; a given name has the gender that its title says, or ``n``."""
    found: list[tuple[int, int, str, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower(), "n") for m in _EMAIL.finditer(text)]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "secret", m[0], "n") for m in _SECRET.finditer(text)]
        found += [(m.start(), m.end(), "ip", m[0], "n") for m in _IP.finditer(text)]
        found += [(m.start(), m.end(), "account", re.sub(r" ", "", m[0]), "n") for m in _IBAN.finditer(text)]
        for kind, pattern in (("ssn", _SSN), ("card", _CARD), ("phone", _PHONE)):
            found += [(m.start(), m.end(), kind, re.sub(r"\D", "", m[0]), "n") for m in pattern.finditer(text)]
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), "secret", m[1], "n") for m in _ASSIGNED.finditer(text)]
    names: dict[str, str] = {}
    for m in _NAME.finditer(text):
        parts = [(p.start() + m.start(2), p.end() + m.start(2), p[0]) for p in re.finditer(r"\S+", m[2])]
        # one name after a title is a family name, but for known given ones
        given = parts[:1] if len(parts) == 2 or parts[0][2] in KNOWN else []
        for a, b, name in given:
            found.append((a, b, "given", name.casefold(), TITLES[m[1]]))
            names[name] = "given"
        for a, b, name in parts[len(given) :]:
            found.append((a, b, "family", name.casefold(), "n"))
            names.setdefault(name, "family")
    if names:
        # the same names without a title, as written there or in capitals
        spelled = {x: n for n in names if len(n) > 2 for x in (n, n.upper())}
        for m in _CAPITAL.finditer(text):
            if m[0] in spelled:
                found.append((m.start(), m.end(), names[spelled[m[0]]], m[0].casefold(), "n"))
    found.sort(key=lambda e: (e[0], -e[1]))
    out, end = [], 0
    for e in found:
        if e[0] >= end:
            out.append(e)
            end = e[1]
    return out


class Stream:
    """Numbers that a key, a type, a value and an attempt decide."""

    def __init__(self, key: str, *parts):
        seed = "\0".join(map(str, parts)).encode("utf-8", "surrogatepass")
        self.data, self.n, self.seed = b"", 0, hmac.new(key.encode(), seed, hashlib.sha256).digest()

    def below(self, n: int) -> int:
        if len(self.data) < 4:
            self.data += hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest()
            self.n += 1
        x, self.data = int.from_bytes(self.data[:4], "big"), self.data[4:]
        return x % n


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if d > "4" else 2 * int(d)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def alike(text: str, draw: Stream, hexadecimal: bool = False) -> str:
    """Each character replaced by one of its kind: digits, letters by script and case (hexadecimal ones where the
    text is such); letters of other scripts become ASCII ones, marks stay."""
    out = []
    for c in text:
        if c.isdigit():
            out.append("0123456789"[draw.below(10)])
        elif c.isalpha():
            letters = "abcdef" if hexadecimal else next((x for a, b, x in ALPHABETS if a <= ord(c) <= b), "abcdefghijklmnopqrstuvwxyz") if ord(c) > 0x36F else "abcdefghijklmnopqrstuvwxyz"
            d = letters[draw.below(len(letters))]
            out.append(d.upper() if c.isupper() else d)
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, value: str, attempt: int, key: str) -> str:
    """The surrogate's normal form. Every third attempt widens the space that it is drawn from (a longer
    value; for addresses another range, then IPv6), so that any number of entities find one."""
    draw, more = Stream(key, kind, value, attempt), attempt // 3
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{alike(local + 'x' * more, draw)}@{alike(host, draw)}.{top}"
    if kind == "ip":
        private = re.match(r"10\.|127\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.", value)
        if more > 1:
            # unique local addresses for private ones, the documentation range for others
            groups = ["fd00" if private else "2001", *([] if private else ["db8"])]
            return ":".join([*groups, *(f"{draw.below(65536):x}" for _ in range(8 - len(groups)))])
        head = private[0].rstrip(".").split(".") if private else [str(1 + draw.below(223))]
        if private and more:
            head = ["10"]
        return ".".join([*head, *(str(1 + draw.below(254)) for _ in range(4 - len(head)))])
    if kind in ("phone", "ssn"):
        keep = 1 if kind == "phone" else 0
        return value[:keep] + alike(value[keep:] + "0" * more, draw)
    if kind == "card":
        made = value[0] + alike(value[1:] + "0" * more, draw)
        if luhn(value):
            made = next(x for x in (made[:-1] + d for d in "0123456789") if luhn(x))
        return made
    if kind == "account":
        return value[:2] + alike(value[2:] + "0" * more, draw)
    if kind == "secret":
        if not any(c.isdigit() or c.isalpha() for c in value):
            value = "x" * len(value)  # marks alone, as in a masked value: nothing that alike changes
        return alike(value + "0" * more, draw, hexadecimal=bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value)))
    script = "cyrillic" if re.search(r"[а-яё]", value) else "greek" if re.search("[α-ωά-ώ]", value) else "latin"
    gender = kind[-1] if kind.startswith("given_") else "n"
    syllables, ends = SYLLABLES[script], ENDINGS[script, gender]
    pieces_ = re.split(r"([-'’])", value)  # a double name stays one, with its marks
    made = ["".join(syllables[draw.below(len(syllables))] for _ in range((2 if len(pieces_) == 1 else 1) + more)) if i % 2 == 0 and x else x for i, x in enumerate(pieces_)]
    last = max((i for i, x in enumerate(pieces_) if i % 2 == 0 and x), default=0)
    made[last] += ends[draw.below(len(ends))]
    return "".join(made)


def in_layout(kind: str, made: str, mention: str) -> str:
    """The surrogate written as the mention is: its separators, its case. What a longer surrogate has
    beyond the mention follows at its end."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(made)
        return "".join([*(next(digits) if c.isdigit() else c for c in mention), *digits])
    if kind == "account":
        marks = iter(made)
        return "".join([*(c if c == " " else next(marks) for c in mention), *marks])
    if kind == "email":
        return made.upper() if mention.isupper() else made
    if kind in ("given", "family"):
        if mention.isupper():
            return made.upper()
        # capitals where the mention's parts have them
        caps = [x[:1].isupper() for x in re.split("[-'’]", mention)]
        return "".join(x if i % 2 else x[:1].upper() + x[1:] if (caps[i // 2] if i // 2 < len(caps) else True) else x for i, x in enumerate(re.split(r"([-'’])", made)))
    return made


def mention_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, th, start, stop, kind, value, gender) of the texts' entities."""
    for piece in pieces(batches, "text"):
        rows, out = [], []
        for i, text in enumerate(piece.column("text").to_pylist()):
            some = detect(text or "")
            rows += [i] * len(some)
            out += some
        at = pa.array(rows, pa.int64())
        start, stop, kind, value, gender = zip(*out) if out else ((), (), (), (), ())
        yield pa.record_batch([piece.column("id").take(at), piece.column("th").take(at), pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(kind, pa.string()), pa.array(value, pa.string()), pa.array(gender, pa.string())], ["id", "th", "start", "stop", "kind", "value", "gender"])


def draws(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [surrogate(*x, key) for x in zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "attempt")))]
        yield pa.record_batch([*(batch.column(c) for c in ("kind", "value", "attempt")), pa.array(made, pa.string())], ["kind", "value", "attempt", "made"])


def last_draws(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """(kind, value, made) with 256 bits of the key's digest of the entity: digits for numbers, letters for the rest."""
    for batch in batches:
        rows = list(zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist()))
        digest = [int.from_bytes(hmac.new(key.encode(), f"{k}\0{v}\0last".encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), "big") for k, v in rows]
        made = [f"{d:078d}" if k in ("phone", "ssn", "card") else "".join("abcdefghijklmnop"[int(x, 16)] for x in f"{d:064x}") for d, (k, _) in zip(digest, rows)]
        yield pa.record_batch([batch.column("kind"), batch.column("value"), pa.array(made, pa.string())], ["kind", "value", "made"])


def assign(entities: DataFrame, folder: str, key: str, rounds: int = 64) -> DataFrame:
    """(kind, value, made) of distinct (kind, value): surrogates that are distinct within a kind and equal
    no entity of it. Given names of all genders share one space.

    A round draws for the entities that are still open and adds those that settle; earlier rounds' parts are
    read and not written again. As attempts widen the spaces, all entities settle long before the rounds
    end; whatever is left then gets a surrogate as long as a digest, which nothing else can have.
    """
    space = lambda kind: F.when(F.col(kind).startswith("given_"), F.lit("given")).otherwise(F.col(kind))
    real = entities.select(space("kind").alias("space"), F.col("value").alias("made")).distinct()
    settled, open_ = None, entities.select("kind", "value", F.lit(0).alias("attempt"))
    for turn in range(rounds):
        drawn = written(open_.mapInArrow(lambda b: draws(b, key), "kind string, value string, attempt int, made string").withColumn("space", space("kind")), folder, f"drawn/{turn}")
        taken = real if settled is None else real.unionByName(settled.select("space", "made"))
        # of those that drew one surrogate the first by its own hash has it, unless it is taken
        best = drawn.groupBy("space", "made").agg(F.min(F.struct(F.xxhash64("kind", "value").alias("h"), "kind", "value")).alias("best"))
        won = best.select("space", "made", "best.kind", "best.value").join(taken.hint("merge"), ["space", "made"], "left_anti")
        won = written(won.select("kind", "value", "made", "space"), folder, f"settled/{turn}")
        settled = won if settled is None else settled.unionByName(won)
        open_ = written(drawn.join(won.select("kind", "value").hint("merge"), ["kind", "value"], "left_anti").select("kind", "value", F.lit(turn + 1).alias("attempt")), folder, f"open/{turn}")
        if open_.isEmpty():
            return settled.select("kind", "value", "made")
    # what never settles takes a name that its own digest makes
    rest = open_.mapInArrow(lambda b: last_draws(b, key), "kind string, value string, made string")
    return settled.select("kind", "value", "made").unionByName(rest) if settled is not None else rest


def replace_mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (row, text, found): (row, n_entities, text with each mention replaced)."""
    for piece in pieces(batches, "text"):
        counts, texts = [], []
        for text, found in zip(piece.column("text").to_pylist(), piece.column("found").to_pylist()):
            at, out = 0, []
            for f in sorted(found or (), key=lambda f: f["start"]):
                out += [text[at : f["start"]], in_layout(f["kind"], f["made"], text[f["start"] : f["stop"]])]
                at = f["stop"]
            counts.append(len(found or ()))
            texts.append("".join(out) + text[at:] if found else text)
        yield pa.record_batch([piece.column("row"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())], ["row", "n_entities", "text"])


class Surrogates:
    """``mentions`` (id, th, start, stop, kind, value, gender), ``mapping`` (kind, value, made), and :meth:`apply`.
    ``key``: else the session's."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, key: str | None = None):
        key = key or docs.sparkSession.conf.get(KEY_SETTING, None)
        if not key:
            raise ValueError(f"surrogates need a key: pass one or set {KEY_SETTING}")
        self.docs, self.id_col, self.text_col = docs, id_col, text_col
        folder = folder or work_folder(docs.sparkSession)
        texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
        made = T.StructType([texts.schema["id"], T.StructField("th", T.LongType()), *(T.StructField(c, T.IntegerType()) for c in ("start", "stop")), *(T.StructField(c, T.StringType()) for c in ("kind", "value", "gender"))])
        self.mentions = written(texts.mapInArrow(mention_lists, made), folder, "mentions")
        said = [F.count_if(F.col("gender") == g).alias(g) for g in "mf"]
        known = F.when(F.col("value").isin(*[x.casefold() for x in FEMALE]), "f").when(F.col("value").isin(*[x.casefold() for x in MALE]), "m").otherwise("n")
        gender = F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > F.col("f"), "m").otherwise(known)
        kind = F.when(F.col("kind") == "given", F.concat(F.lit("given_"), gender)).otherwise(F.col("kind"))
        entities = written(self.mentions.groupBy("kind", "value").agg(*said).select(kind.alias("kind"), "value"), folder, "entities")
        made_for = assign(entities, folder, key)
        self.mapping = made_for.withColumn("kind", F.when(F.col("kind").startswith("given_"), "given").otherwise(F.col("kind")))

    def apply(self) -> DataFrame:
        """The rows of docs with their text replaced, all columns in place, and a last column n_entities (with a
        leading underscore where docs has one)."""
        named = self.mentions.drop("gender").distinct().join(self.mapping.hint("merge"), ["kind", "value"])
        found = named.groupBy("id", "th").agg(F.collect_list(F.struct("start", "stop", "kind", "made")).alias("found")).withColumnsRenamed({"id": "f_id", "th": "f_th"})
        docs = self.docs
        rows = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != self.text_col]).alias("row"), F.col(self.id_col).alias("id"), F.coalesce(F.col(self.text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
        both = rows.join(found.hint("merge"), rows["id"].eqNullSafe(found["f_id"]) & (rows["th"] == found["f_th"]), "left").select("row", "text", "found")
        out = both.mapInArrow(replace_mentions, T.StructType([rows.schema["row"], T.StructField("n_entities", T.LongType()), T.StructField("text", T.StringType())]))
        return out.select(*[F.col("text").alias(c) if c == self.text_col else F.col("row")[c].alias(c) for c in docs.columns], F.col("n_entities").alias(fresh(docs, "n_entities")[0]))


def surrogate_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_entities, text with surrogates.

    A null text becomes an empty one; texts of any length are processed whole. Rows that repeat an id are
    treated each by its own text, and equal rows alike. Other columns are not read. An empty table gives
    an empty result.
    """
    only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return Surrogates(only, key=key).apply().select("doc_id", "n_entities", "text")
