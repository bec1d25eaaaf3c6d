"""Base spans against the patterns as they stand, and the field on held-out words."""

import hashlib
import random
import re

import numpy as np
import pytest

from inkrank.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(n // 10 + n % 10 for n in double) % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def card(rng, size=16):
    digits = "".join(rng.choice("0123456789") for _ in range(size - 1))
    return next(digits + d for d in "0123456789" if pii.luhn(digits + d))


def planted(rng):
    return rng.choice([
        lambda: f"{rng.choice('abc')}.x{rng.randint(0, 99)}@mail{rng.randint(0, 9)}.example.com",
        lambda: ".".join(str(rng.randint(0, 299)) for _ in range(rng.choice([3, 4, 5, 8]))),
        lambda: " ".join(re.findall("....", card(rng))),
        lambda: card(rng, rng.choice([15, 16, 19, 20])),
        lambda: f"+{rng.randint(1, 99)} ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}",
        lambda: f"{rng.randint(1000, 9999)}",
    ])()


def noise(rng, n):
    return "".join(rng.choice(["a", "é", "1", "22", "@", ".", "+", "-", " ", "(", ")", "@b.c", "\n", "日"]) for _ in range(n))


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(4000):
        text = noise(rng, rng.randint(0, 40)) + planted(rng) + noise(rng, rng.randint(0, 6)) + planted(rng)
        assert pii.base_spans(text) == brute(text)


@pytest.mark.parametrize("piece", ["a", "1", "1.", "@", "+1 ", "a@", "a@a", "0", "1 ", "+", "@a.", "x1 "])
def test_long_texts_take_linear_time(piece):
    text = piece * (300_000 // len(piece))
    pii.base_spans(text)
    found = pii.sequences(text)
    assert sum(len(row.starts) for row in found) <= len(text)


def labelled(rng, n):
    rows = []
    for _ in range(n):
        words = ["Wort", "the", "of,", "Est", "une."]
        text = " ".join([*rng.choices(words, k=rng.randint(0, 5)), planted(rng), *rng.choices(words, k=3)])
        for found in pii.sequences(text):
            rows.append((pii.features(found.shapes), pii.labels_of(found, pii.base_spans(text))))
    return [x for x, _ in rows], [y for _, y in rows]


@pytest.fixture(scope="module")
def field():
    return pii.train(*labelled(random.Random(1), 800))


def test_field_on_held_out_words(field):
    rows, labels = labelled(random.Random(2), 400)
    found = field.decode(rows)
    right = sum((a == b).sum() for a, b in zip(found, labels, strict=True))
    assert right >= 0.97 * sum(map(len, labels))


def test_viterbi_equals_all_paths(field):
    rng = np.random.default_rng(4)
    from itertools import product

    rows = [rng.integers(0, pii._FEATURES, (n, 5)) for n in (1, 2, 4, 5)]
    some = pii.Field(rng.normal(size=field.emit.shape), rng.normal(size=field.follow.shape))
    for row, labels in zip(rows, some.decode(rows), strict=True):
        scores = some.emit[row].sum(axis=1)
        total = lambda path: sum(scores[t, y] for t, y in enumerate(path)) + sum(
            some.follow[a, b] for a, b in zip(path[:-1], path[1:], strict=True)
        )
        assert tuple(labels) == max(product(range(5), repeat=len(row)), key=total)


def test_field_adds_what_the_patterns_miss(field):
    text = "the of (528) 555-9632 Est une. Call of, 12 the"
    [(base, more)] = pii.spans_of([text], field)
    assert base == [] and [(k, text[a:b]) for k, a, b in more] == [("phone", "(528) 555-9632")]


def test_field_leaves_plain_numbers_alone(field):
    text = "the year 1999 of, 12.5 and 300 4,000 v1.2.3 2024-05-06 10:30 section 4.1 x1y2"
    assert pii.spans_of([text], field) == [([], [])]


def test_redacted():
    text = "a b@c.d +1 234 567 89 z"
    spans = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
    assert pii.redacted(text, spans) == "a [EMAIL] [PHONE] z"
    assert pii.redacted("abcdef", "ip:1:4,phone:2:5") == "a[IP]f"
    assert pii.redacted("abc", "") == "abc"


def test_query(spark, documents, tmp_path):
    rng = random.Random(8)
    texts = [None, "", "no digits", "é 日本 x@y.z", "7 " * 100_000]
    texts += [f"Wort {planted(rng)} the of, {planted(rng)}" for _ in range(200)]
    documents([*enumerate(texts), (None, "a@b.c"), (4, "again 1.2.3.4"), (4, "again 1.2.3.4")]).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    rows = queries.op2_pii(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 3
    for row in rows:
        if row.doc_id is None or row.doc_id == 4:
            continue
        base = brute(texts[row.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        for kind in pii.KINDS:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        assert set(filter(None, written.split(","))) <= set(row.spans.split(","))
    [row] = [r for r in rows if r.doc_id is None]
    assert row.spans == "email:0:5"
    documents([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op2_pii(spark, f"{tmp_path}/none").count() == 0


@pytest.fixture(scope="module")
def made_field():
    table = pii.made_sequences()
    return pii.train([pii.features(shapes) for shapes, _ in table], [np.array(labels) for _, labels in table])


@pytest.mark.parametrize(
    ("kind", "item"),
    [("phone", "(528) 555-9632"), ("phone", "528-555-9632"), ("card", "4465.7583.8288.9430"), ("ip", "187[.]54[.]28[.]246")],
)
def test_made_table_teaches_what_the_patterns_miss(made_field, kind, item):
    item = next(item[:-1] + d for d in "0123456789" if pii.luhn(pii._digits(item[:-1] + d))) if kind == "card" else item
    text = f"the of {item} Est une"
    assert pii.spans_of([text], made_field) == [([], [(kind, 7, 7 + len(item))])]


def test_made_table_leaves_plain_numbers_alone(made_field):
    text = "the year 1999 of, 12.5 and 300 4,000 v1.2.3 2024-05-06 10:30 section 4.1 x1y2"
    assert pii.spans_of([text], made_field) == [([], [])]


def test_doubtful_words_are_no_examples(spark, documents):
    texts = ["call (528) 555-9632 une", "4465 7583 8288 9437 4465 7583 8288 9437 x", "year 1999 of", "mail a@b.c Wort"]
    table = pii.labelled_words(documents([*enumerate(texts)]))
    shapes = {shape: label for row in table for shape, label in zip(*row, strict=True)}
    assert shapes["<4>"] == 0 and shapes["x@x.x"] == 1
    assert not {"(<3>)", "<3>-<4>"} & set(shapes) and len(table) == 2


def test_corpus_without_base_spans_still_adds(spark, documents):
    texts = [f"call (528) 555-{9000 + i} une, year {1900 + i} of" for i in range(60)]
    rows = pii.personal_data(documents([*enumerate(texts)])).collect()
    assert [row.spans for row in rows] == ["phone:5:19"] * 60


PHONE_A, PHONE_B, CARD_A, CARD_B = "(528) 555-9632", "(528) 555-9633", "4539 1488 0343 6467", "4485 2757 4230 8327"
LISTS = [
    ("phone", "{} {}", [PHONE_A, PHONE_B]),
    ("phone", "{}, {}", [PHONE_A, PHONE_B]),
    ("phone", "{}; {}", ["528-555-9632", "528-555-9633"]),
    ("phone", "{}\n{} {}", ["528 555 9632", "528 555 9633", "743 555 3824"]),
    ("phone", "{} {}", ["+1 (743) 555-3824", PHONE_A]),
    ("phone", "{} {}", ["+1 743 555 3824", "+1 743 555 3825"]),
    ("card", "{} {}", [CARD_A, CARD_B]),
    ("card", "{} {}", [CARD_A.replace(" ", ""), CARD_B.replace(" ", "")]),
    ("card", "{},{}", [CARD_A.replace(" ", "."), CARD_B.replace(" ", ".")]),
]


@pytest.mark.parametrize(("kind", "form", "items"), LISTS)
def test_items_of_a_list_are_found_each(kind, form, items):
    text = f"the of, {form.format(*items)} une"
    [found] = pii.sequences(text)
    own = [(text.index(item), text.index(item) + len(item)) for item in items]
    label = pii.KINDS.index(kind) + 1
    labels = np.array([label * (own[0][0] <= a < own[-1][1]) for a in found.starts])
    base = pii.base_spans(text)
    more = pii.added_spans(text, found, labels, pii._merged(base))
    assert sorted(text[a:b] for _, a, b in base + more) == sorted(items)


def test_added_spans_are_cut_at_base_spans():
    text = "the 1.2.3.4 (528) 555-9632 10.0.0.1, 528-555-9633 une"
    [found] = pii.sequences(text)
    base = pii.base_spans(text)
    labels = np.array([4 * any(c.isdigit() for c in text[a:b]) for a, b in zip(found.starts, found.ends, strict=True)])
    more = pii.added_spans(text, found, labels, pii._merged(base))
    assert [(k, text[a:b]) for k, a, b in more] == [("phone", PHONE_A), ("phone", "528-555-9633")]
    assert not any(x < b and a < y for _, x, y in base for _, a, b in more)


def test_lists_are_redacted_by_the_made_field(made_field):
    text = f"call {PHONE_A}, {PHONE_B} or {CARD_A} {CARD_B} une"
    [(base, more)] = pii.spans_of([text], made_field)
    assert pii.redacted(text, pii._text_of(base + more)) == "call [PHONE], [PHONE] or [CARD] [CARD] une"


def test_long_runs_take_linear_time():
    for piece in ("7 ", "12", "1.", "55 555 ", "a@", "(1) "):
        text = "12 " + piece * (20_000 // len(piece)) + "x"
        for found in pii.sequences(text):
            for label in range(1, 5):
                pii.added_spans(text, found, np.full(len(found.starts), label), ([], []))
