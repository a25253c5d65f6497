"""Surrogates in texts made from slots: nothing of the library says where the entities are."""

import random
import re
import sys
import unicodedata
from collections import defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import pii_surrogates as P  # noqa: E402


def luhn_card(rng):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    total = sum(int(d) if i % 2 else (2 * int(d) - 9 if d > "4" else 2 * int(d)) for i, d in enumerate(reversed(body)))
    return body + str(-total % 10)


def slotted(seed, n=120):
    """Rows, and for each the pieces: ('', literal text) or (type, entity, written form)."""
    rng = random.Random(seed)
    given = {"Sabine": "f", "Ahmed": "m", "Łukasz": "m", "Jean-Pierre": "m", "Анна": "f", "Ελένη": "f", "Robin": None}
    family = ["Weber", "Żak", "O'Neil", "Иванова", "Παππά", "Keller-Braun"]
    mails = [f"{a}{k}@{b}" for a in ("anna.smith", "иван", "x") for k in range(4) for b in ("mail.example.com", "пример.рф")]
    phones = [f"{rng.randrange(200, 990)}555{rng.randrange(1000, 9999)}" for _ in range(9)]
    cards, ips = [luhn_card(rng) for _ in range(6)], [f"192.168.{k}.{k + 7}" for k in range(6)] + [f"8.{k}.4.{k}" for k in range(6)]
    rows, plan = [], []
    for i in range(n):
        parts = [("", f"row {i}: ")]
        for _ in range(rng.randrange(0, 5)):
            kind = rng.choice(["name", "name", "email", "phone", "card", "ip", "plain"])
            if kind == "name":
                a, b = rng.choice(list(given)), rng.choice(family)
                title = {"m": "Mr. ", "f": "Frau ", None: "Dr. "}[given[a]] if rng.random() < 0.6 else "Prof. "
                parts += [("", title), ("given", a, a), ("", " "), ("family", b, b), ("", " came. ")]
                if rng.random() < 0.5:
                    parts += [("given", a, a), ("", " and "), ("family", b, b.upper()), ("", " left; ")]
            elif kind == "email":
                x = rng.choice(mails)
                parts += [("", "mail "), ("email", x, x), ("", " now, ")]
            elif kind == "phone":
                x = rng.choice(phones)
                parts += [("", "call "), ("phone", x, rng.choice([f"({x[:3]}) {x[3:6]}-{x[6:]}", f"{x[:3]}-{x[3:6]}-{x[6:]}"])), ("", " today, ")]
            elif kind == "card":
                x = rng.choice(cards)
                parts += [("", "card "), ("card", x, rng.choice([x, " ".join(x[k : k + 4] for k in range(0, 16, 4))])), ("", " paid, ")]
            elif kind == "ip":
                x = rng.choice(ips)
                parts += [("", "from "), ("ip", x, x), ("", " seen, ")]
            else:
                parts.append(("", "Nothing at 12:30, version 1.2.3 and 40,000 words. "))
        rows.append((i, "".join(p[-1] for p in parts), "en", "s", 0))
        plan.append(parts)
    return rows, plan, given


@pytest.mark.parametrize("seed", [1, 2])
def test_every_slot_and_nothing_else_is_replaced(spark, seed):
    rows, plan, given = slotted(seed)
    out = {r["doc_id"]: r for r in P.surrogate_texts(corpus.frame(spark, rows).repartition(3), key="slots").collect()}
    made, owner = defaultdict(set), defaultdict(set)
    for (i, *_), parts in zip(rows, plan):
        pattern = "".join(re.escape(p[1]) if not p[0] else "(.+?)" for p in parts)
        m = re.fullmatch(pattern, out[i]["text"])
        slots = [p for p in parts if p[0]]
        assert m and out[i]["n_entities"] == len(slots)
        for (kind, entity, written), new in zip(slots, m.groups()):
            plain = re.sub(r"\D", "", new) if kind in ("phone", "card") else new.casefold()
            made[kind, entity].add(plain)
            owner[kind, plain].add(entity)
            assert plain != entity.casefold()
            # layout, script and case of what was written
            if kind in ("phone", "card"):
                assert re.sub(r"\d", "0", new) == re.sub(r"\d", "0", written)
            if kind == "card":
                assert new[0] == "4" and P.luhn(plain)
            if kind == "ip":
                assert re.fullmatch(r"\d+(\.\d+){3}", new) and new.startswith("192.168.") == written.startswith("192.168.")
            if kind in ("given", "family", "email"):
                script = lambda t: {unicodedata.name(c).split(" ")[0] for c in t if c.isalpha()}
                assert script(new) == script(written), (written, new)
                assert re.sub(r"[^\W\d_]", "", new) == re.sub(r"[^\W\d_]", "", written) or kind == "email"
                assert new.isupper() == written.isupper()
            if kind == "email":
                assert re.sub(r"[^@.]", "", new) == re.sub(r"[^@.]", "", written) and new.rpartition(".")[2] == written.rpartition(".")[2]
            if kind == "given" and given[entity]:
                assert new.casefold().endswith(("a", "elle", "а", "я", "α", "η")) == (given[entity] == "f"), (entity, new)
    # one entity, one surrogate, and no two share one
    assert all(len(x) == 1 for x in made.values()) and all(len(x) == 1 for x in owner.values()) and len(made) > 30


def test_one_person_in_one_sentence_and_known_single_names(spark):
    texts = ["Dr. Sabine Weber met us. Frau Sabine Weber said so.", "Dr. Anna wrote. Dr. Keller too, and Anna again.", "Mr. Kim Lee. Mrs. Kim Lee."]
    a, b, c = (r["text"] for r in P.surrogate_texts(corpus.frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]), key="k").orderBy("doc_id").collect())
    m = re.fullmatch(r"Dr\. (\w+) (\w+) met us\. Frau (\w+) (\w+) said so\.", a)
    assert m and m[1] == m[3] and m[2] == m[4] and m[1].endswith(("a", "elle"))
    m = re.fullmatch(r"Dr\. (\w+) wrote\. Dr\. (\w+) too, and (\w+) again\.", b)
    assert m and m[1] == m[3] and m[1].endswith(("a", "elle"))
    m = re.fullmatch(r"Mr\. (\w+) (\w+)\. Mrs\. (\w+) (\w+)\.", c)
    assert m and m[1] == m[3] and m[2] == m[4]


def test_a_generator_that_never_settles_still_ends(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "surrogate", lambda kind, value, attempt, key: "same")
    entities = spark.createDataFrame([("phone", f"{i}") for i in range(5)] + [("email", "a@b.c"), ("given_f", "x"), ("given_m", "y")], "kind string, value string")
    real = P.draws

    def same(batches, key):
        for batch in real(batches, key):
            yield batch.set_column(3, "made", __import__("pyarrow").array(["same"] * batch.num_rows))

    monkeypatch.setattr(P, "draws", same)
    out = P.assign(entities, f"file://{tmp_path}/x", "k", rounds=2).collect()
    assert len(out) == 8 and len({(r["kind"].split("_")[0], r["made"]) for r in out}) == 8
    assert all(r["made"].isdigit() or r["made"] == "same" for r in out if r["kind"] == "phone")
