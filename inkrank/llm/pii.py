"""Personal data in texts: fixed patterns, and a conditional random field beside them.

The patterns give the base spans. A linear-chain conditional random field over
the shapes of words then labels the words around every digit and at-sign, and
adds what the patterns miss, such as a telephone number without its plus sign.
It is decoded by Viterbi over many sequences at once.

It is trained on a small labelled table made by rule (``made_sequences``), which
holds personal data in forms that the patterns know and in forms they miss, and
look-alikes. Sequences of the corpus are added to it, labelled by the patterns but
for those with a word that may be personal data although no pattern takes it.

An added span never overlaps a base span, and has to be plausible for its kind (see
``_plausible``), so texts without personal data are left alone. Neighbouring words of
one label that are not one item, as in a list, are cut into items.

Edge cases: null and empty texts have no spans; without any base span in the
corpus the field is that of the made table; repeated rows get the same answer each.
"""

from __future__ import annotations

import random
import re
import string
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkrank.llm.common import lowest, sliced, texts
from inkrank.session import scratch_path, settle

KINDS = ("email", "ip", "card", "phone")

#: The base patterns. Starts inside a run of digits are left out
#: where they could only repeat what failed at its first digit.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUPED = re.compile(r"\(?[0-9]{1,4}\)?[ .\-/]\(?[0-9]{2,4}\)?(?:[ .\-/]?[0-9]{2,4})+")
#: What items of a list are made of: between marks of a list, and where a number may be
#: cut as well.
_LISTED = re.compile(r"[^\s,;|]+")
_PIECE = re.compile(r"[^\s,;|/]+")

_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_MARK = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")
_DIGIT = re.compile(r"[0-9]")

#: Words on each side of a marked word that belong to its sequence.
CONTEXT = 3
#: Documents and sequences of the corpus that the field is trained on at most, beside
#: the made ones.
TRAINING_DOCS = 500
TRAINING_SEQUENCES = 4000
#: Words of a training sequence at most; longer ones are labelled, but not learnt from.
TRAINING_WORDS = 200
MADE_TEXTS = 2000

_FEATURES = 1 << 14
_LABELS = len(KINDS) + 1
_STEPS, _RATE, _PENALTY = 100, 0.15, 1e-4

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at-sign outward, which takes linear time on any text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (found := _DOMAIN.match(text, at + 1)):
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind and then by start."""
    if not _MARK.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    for found in _IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in found.group().split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            out.append(("ip", *found.span()))
    for found in _CARD.finditer(text):
        digits = _digits(found.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *found.span()))
    for found in _PHONE.finditer(text):
        if 8 <= len(_digits(found.group())) <= 15:
            out.append(("phone", *found.span()))
    return out


# --- sequences and features -------------------------------------------------


def shape(word: str) -> str:
    """Capitals as X, other letters as x, digits as their number, marks as such."""
    out: list[str] = []
    digits = 0
    for c in word:
        if "0" <= c <= "9":
            digits += 1
            continue
        if digits:
            out.append(f"<{min(digits, 20)}>")
            digits = 0
        kind = "X" if c.isupper() else "x" if c.isalpha() else c if c.isascii() else "?"
        if not out or out[-1] != kind or kind not in "Xx":
            out.append(kind)
    if digits:
        out.append(f"<{min(digits, 20)}>")
    return "".join(out)


@dataclass
class Sequence:
    """Some neighbouring words of a text, by their places in it."""

    starts: list[int]
    ends: list[int]
    shapes: list[str]


def sequences(text: str) -> list[Sequence]:
    """The words with a digit or an at-sign and ``CONTEXT`` words beside them."""
    if not _MARK.search(text):
        return []
    words = [found.span() for found in _WORD.finditer(text)]
    marked = [i for i, (a, b) in enumerate(words) if _MARK.search(text, a, b)]
    groups: list[list[int]] = []
    for i in marked:
        low, high = max(0, i - CONTEXT), min(len(words), i + CONTEXT + 1)
        if groups and low <= groups[-1][1]:
            groups[-1][1] = high
        else:
            groups.append([low, high])
    out = []
    for low, high in groups:
        own = words[low:high]
        out.append(Sequence([a for a, _ in own], [b for _, b in own], [shape(text[a:b]) for a, b in own]))
    return out


def _slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % _FEATURES


def features(shapes: list[str]) -> np.ndarray:
    """Five feature numbers a word: its shape, its class, its neighbours', digits."""
    own = ["^", *shapes, "$"]
    rough = [re.sub(r"<\d+>", "<>", s) for s in own]
    rows = [
        (
            _slot("w" + own[i]),
            _slot("r" + rough[i]),
            _slot("p" + rough[i - 1]),
            _slot("n" + rough[i + 1]),
            _slot("a" + rough[i - 1] + " " + rough[i]),
        )
        for i in range(1, len(own) - 1)
    ]
    return np.array(rows, np.int64).reshape(-1, 5)


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers as (sequence, word, feature), and the lengths. Padding
    points at the last number, which has no weight."""
    sizes = np.array([len(row) for row in rows])
    out = np.full((len(rows), sizes.max(), 5), _FEATURES, np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out, sizes


# --- the field --------------------------------------------------------------


@dataclass
class Field:
    """Weights by feature and label, and by label after label."""

    emit: np.ndarray
    follow: np.ndarray

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        return self.emit[numbers].sum(axis=2)

    def decode(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of many sequences at once, by Viterbi."""
        if not rows:
            return []
        numbers, sizes = _padded(rows)
        scores = self.scores(numbers)
        best, back = scores[:, 0], []
        for t in range(1, scores.shape[1]):
            through = best[:, :, None] + self.follow
            step = through.max(axis=1) + scores[:, t]
            live = (t < sizes)[:, None]
            back.append(np.where(live, through.argmax(axis=1), np.arange(_LABELS)))
            best = np.where(live, step, best)
        label = best.argmax(axis=1)
        out = np.zeros(scores.shape[:2], np.int64)
        out[:, -1] = label
        for t in range(len(back) - 1, -1, -1):
            label = back[t][np.arange(len(label)), label]
            out[:, t] = label
        return [row[:n] for row, n in zip(out, sizes, strict=True)]


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def train(rows: list[np.ndarray], labels: list[np.ndarray]) -> Field:
    """Maximum likelihood with a small penalty, by forward-backward sums."""
    field = Field(np.zeros((_FEATURES + 1, _LABELS)), np.zeros((_LABELS, _LABELS)))
    if not rows or not any(x.any() for x in labels):
        field.emit[:-1, 0] = 1.0  # nothing but "no label" was seen
        return field
    numbers, sizes = _padded(rows)
    count, width = numbers.shape[:2]
    live = np.arange(width) < sizes[:, None]
    truth = np.zeros((count, width), np.int64)
    for i, row in enumerate(labels):
        truth[i, : len(row)] = row
    seen = np.eye(_LABELS)[truth] * live[:, :, None]
    pairs = live[:, 1:]
    seen_pairs = np.einsum("std,ste->de", seen[:, :-1] * pairs[:, :, None], seen[:, 1:])
    weights = [field.emit, field.follow]
    mean = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    for step in range(1, _STEPS + 1):
        scores = field.scores(numbers)
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, width):
            new = _sum_exp(ahead[:, t - 1, :, None] + field.follow, 1) + scores[:, t]
            ahead[:, t] = np.where(live[:, t, None], new, ahead[:, t - 1])
        for t in range(width - 2, -1, -1):
            new = _sum_exp(field.follow + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(live[:, t + 1, None], new, 0.0)
        total = _sum_exp(ahead[:, -1], 1)[:, None, None]
        marginal = np.exp(np.minimum(ahead + behind - total, 0)) * live[:, :, None]
        through = ahead[:, :-1, :, None] + field.follow + (scores + behind)[:, 1:, None, :]
        expected = (np.exp(np.minimum(through - total[..., None], 0)) * pairs[:, :, None, None]).sum(axis=(0, 1))
        missing = np.repeat((seen - marginal).reshape(-1, _LABELS), 5, axis=0)
        change = np.stack([np.bincount(numbers.reshape(-1), column, _FEATURES + 1) for column in missing.T], axis=1)
        change[-1] = 0
        for i, grad in enumerate((change / count, (seen_pairs - expected) / count)):
            grad = grad - _PENALTY * weights[i]
            mean[i] = 0.9 * mean[i] + 0.1 * grad
            square[i] = 0.99 * square[i] + 0.01 * grad**2
            weights[i] += _RATE * (1 - (step - 1) / _STEPS) * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
    return field


def labels_of(found: Sequence, spans: list[Span]) -> np.ndarray:
    """The kind each word overlaps most with, by order of kinds; 0 for none."""
    out = np.zeros(len(found.starts), np.int64)
    for kind, a, b in reversed(spans):
        for i, (start, end) in enumerate(zip(found.starts, found.ends, strict=True)):
            if start < b and a < end:
                out[i] = KINDS.index(kind) + 1
    return out


_TRIM = {"email": ".,;:!?()[]{}<>\"'|", "ip": ".,;:!?()[]{}<>\"'|", "card": ".,;:!?()[]{}<>\"'|-", "phone": ".,;:!?]}>[{<\"'|-"}


def _formed(kind: str, text: str) -> bool:
    """Whether a text has the form of its kind, whatever its check digits."""
    digits = _digits(text)
    if kind == "email":
        name, _, host = text.partition("@")
        return bool(name and _DOMAIN.fullmatch(host) and not any(c.isspace() for c in text))
    if kind == "ip":
        parts = re.split(r"\[?\.\]?", text)
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and bool(re.fullmatch(r"[0-9][0-9 .\-/]*[0-9]", text))
    if text.startswith("+"):
        return 8 <= len(digits) <= 15 and bool(_PHONE.fullmatch(text))
    # Digits first: the form takes long on very many of them.
    return 9 <= len(digits) <= 15 and bool(_GROUPED.fullmatch(text))


def _plausible(kind: str, text: str) -> bool:
    """Whether an added span can be what it is labelled."""
    if not _formed(kind, text):
        return False
    if kind == "ip":
        return all(int(part) <= 255 for part in re.findall(r"[0-9]+", text))
    return kind != "card" or luhn(_digits(text))


def _trimmed(kind: str, text: str, a: int, b: int) -> tuple[int, int]:
    part = text[a:b]
    a += len(part) - len(part.lstrip(_TRIM[kind]))
    return a, b - (len(part) - len(part.rstrip(_TRIM[kind] + "(")))


def _parts(kind: str, text: str, a: int, b: int) -> list[Span]:
    """The plausible parts of a stretch that cover most of it, in parts as even as may be."""
    number = kind in ("card", "phone")
    words = [(a + m.start(), a + m.end()) for m in (_PIECE if number else _LISTED).finditer(text[a:b])]
    digits = [len(_digits(text[x:y])) for x, y in words]
    best: list[tuple[int, int]] = [(0, 0)] * (len(words) + 1)
    taken: list[tuple[int, int, int] | None] = [None] * len(words)
    for i in range(len(words) - 1, -1, -1):
        best[i] = best[i + 1]
        n = 0
        for j in range(i, len(words)):
            n += digits[j]
            # Only numbers hold spaces, and have 8 to 19 digits.
            if number and n > 19 or j > i and (not number or words[j][1] - words[i][0] > 64):
                break
            if number and n < 8:
                continue
            x, y = _trimmed(kind, text, words[i][0], words[j][1])
            if x < y and _plausible(kind, text[x:y]):
                size = len("".join(text[x:y].split()))
                now = (best[j + 1][0] + size, best[j + 1][1] - size * size)
                if now > best[i]:
                    best[i], taken[i] = now, (x, y, j + 1)
    out, i = [], 0
    while i < len(words):
        if (found := taken[i]) is None:
            i += 1
            continue
        out.append((kind, *found[:2]))
        i = found[2]
    return out


Held = tuple[list[int], list[int]]


def _merged(spans: list[Span]) -> Held:
    """Starts and ends of the stretches that some spans cover."""
    starts: list[int] = []
    ends: list[int] = []
    for _, a, b in sorted(spans, key=lambda span: span[1:]):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _free(held: Held, a: int, b: int) -> Iterator[tuple[int, int]]:
    """What of a stretch is not covered."""
    starts, ends = held
    i = bisect_right(ends, a)
    while i < len(starts) and starts[i] < b:
        if a < starts[i]:
            yield a, starts[i]
        a = ends[i]
        i += 1
    if a < b:
        yield a, b


def added_spans(text: str, found: Sequence, labels: np.ndarray, held: Held) -> list[Span]:
    """Runs of equally labelled words, cut at the base's spans: as a whole where
    plausible, else their plausible parts."""
    out, i = [], 0
    while i < len(labels):
        j = i + 1
        while j < len(labels) and labels[j] == labels[i]:
            j += 1
        if labels[i]:
            kind = KINDS[labels[i] - 1]
            for x, y in _free(held, found.starts[i], found.ends[j - 1]):
                a, b = _trimmed(kind, text, x, y)
                if a < b:
                    out += [(kind, a, b)] if _plausible(kind, text[a:b]) else _parts(kind, text, a, b)
        i = j
    return out


# --- labelled words ---------------------------------------------------------


def made_item(kind: str, rng: random.Random) -> str:
    """Personal data of a kind, as the patterns know it or in a form they miss."""
    d = lambda n: "".join(rng.choices(string.digits, k=n))
    name = lambda: "".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 8)))
    if kind == "email":
        first = rng.choice([name(), f"{name()}.{name()}", f"{name().title()}{d(2)}", f"{name()}_{name()}", f"{name()}.{d(2)}"])
        return f"{first}@" + rng.choice([f"{name()}.com", f"mail{d(1)}.{name()}.org", f"{name()}-{name()}.co.uk"])
    if kind == "ip":
        return rng.choice([".", ".", ".", "[.]"]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        sign = rng.choice([" ", "-", ".", "/"])
        return rng.choice([
            lambda: d(rng.choice([13, 14, 15, 16, 16, 16, 17, 18, 19])),
            lambda: sign.join(d(4) for _ in range(4)),
            lambda: sign.join([d(4), d(6), d(5)]),
            lambda: sign.join([*(d(4) for _ in range(4)), d(3)]),
        ])()
    sign = rng.choice([" ", "-", ".", "/"])
    return rng.choice([
        lambda: f"+{d(rng.randint(1, 3))} ({d(3)}) {d(3)}-{d(4)}",
        lambda: f"+{d(2)}{sign}{d(3)}{sign}{d(3)}{sign}{d(4)}",
        lambda: f"+{d(rng.randint(10, 13))}",
        lambda: f"({d(3)}) {d(3)}{rng.choice('-. ')}{d(4)}",
        lambda: f"({d(3)}){sign}{d(3)}{sign}{d(4)}",
        lambda: sign.join([d(3), d(3), d(4)]),
        lambda: sign.join(["1", d(3), d(3), d(4)]),
        lambda: f"0{d(rng.randint(2, 3))}{rng.choice([' ', '/', '-'])}{d(rng.randint(6, 8))}",
        lambda: f"00{d(2)} {d(rng.randint(2, 3))} {d(rng.randint(6, 8))}",
        lambda: " ".join([f"0{d(1)}", d(2), d(2), d(2), d(2)]),
    ])()


def made_other(rng: random.Random) -> str:
    """Words with digits or at-signs that are nobody's."""
    d = lambda n: "".join(rng.choices(string.digits, k=n))
    hexa = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    n = lambda top: str(rng.randint(1, top))
    date = (rng.randint(1, 12), rng.randint(1, 28))
    return rng.choice([
        lambda: str(rng.randint(1800, 2030)) + rng.choice(["", ".", ",", ")"]),
        lambda: f"{rng.randint(1900, 2030)}-{date[0]:02}-{date[1]:02}" + rng.choice(["", f" {n(23)}:{d(2)}", f"T{d(2)}:{d(2)}:{d(2)}"]),
        lambda: f"{date[1]}.{date[0]}.{rng.randint(1900, 2030)}",
        lambda: f"{date[0]}/{date[1]}/{rng.randint(1900, 2030)}",
        lambda: f"{n(23)}:{d(2)}" + rng.choice(["", f":{d(2)}"]),
        lambda: rng.choice(["v", "", ""]) + ".".join([n(12), n(20), n(9)]),
        lambda: f"{n(20)}.{n(99)}" + rng.choice(["", ".", "%", ","]),
        lambda: n(999) + rng.choice(["", "", ".", ",", "%", "kg", "th", ")"]),
        lambda: rng.choice(["$", "€", ""]) + f"{n(999)},{d(3)}" + rng.choice(["", f",{d(3)}", f".{d(2)}"]),
        lambda: f"{n(99)}-{n(99)}",
        lambda: f"{n(999)}x{n(999)}",
        lambda: f"x{n(9)}y{n(99)}",
        lambda: f"#{d(rng.randint(2, 7))}",
        lambda: f"No. {rng.randint(1990, 2030)}-{d(5)}",
        lambda: d(rng.randint(4, 11)),
        lambda: d(rng.randint(24, 40)),
        lambda: f"978-{n(9)}-{d(2)}-{d(6)}-{n(9)}",
        lambda: f"10.{d(4)}/{d(rng.randint(2, 6))}",
        lambda: f"{d(4)}.{d(5)}",
        lambda: f"{n(89)}.{d(4)}, {n(179)}.{d(4)}",
        lambda: rng.choice(["", '"']) + hexa(rng.choice([7, 12, 32, 40, 64])) + rng.choice(["", '"']),
        lambda: "-".join(hexa(k) for k in (8, 4, 4, 4, 12)),
        lambda: rng.choice(["@name", "@User", "@", "name@", "name@host", "@a_b", "@Override"]),
        lambda: " ".join(n(rng.choice([9, 99, 999, 9999])) for _ in range(rng.randint(2, 7))),
    ])()


def made_sequences(count: int = MADE_TEXTS, seed: int = 5) -> list[tuple[list[str], list[int]]]:
    """The labelled table kept with the operator: shapes and labels of the sequences of
    ``count`` texts with items by themselves and in lists, and look-alikes."""
    rng = random.Random(seed)
    words = ["the", "of", "Wort", "une", "von,", "Est", "call", "Tel.", "phone:", "from", "IP", "mail:", "(see", "page",
             "or", "and", "éti", "card", "No.", "Nter,", "THE", "ende.", "###", "-", "日本", "section", "year"]
    around = [("", ""), ("", ""), ("", ""), ("", "."), ("", ","), ('"', '"'), ("<", ">"), ("", ";"), ("", "###"), ("", "!!")]
    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(rng.randint(1, 3)):
            text += "".join(f"{word} " for word in rng.choices(words, k=rng.randint(0, 4)))
            if rng.random() < 0.45:
                text += made_other(rng) + " "
                continue
            kind = rng.choice((*KINDS, "phone", "phone"))
            one = [made_item(kind, rng) for _ in range(rng.choice([1, 1, 1, 1, 1, 2, 3]))]
            before, after = rng.choice(around)
            sign = rng.choice([" ", ", ", "; ", "\n", " or ", " / "])
            text += before
            for i, item in enumerate(one):
                text += sign * (i > 0)
                spans.append((kind, len(text), len(text) + len(item)))
                text += item
            text += f"{after} "
        text += " ".join(rng.choices(words, k=rng.randint(0, 4)))
        out += [(found.shapes, labels_of(found, spans).tolist()) for found in sequences(text)]
    return out


def _doubtful(text: str, found: Sequence, base: list[Span]) -> bool:
    """Whether some words beside the base spans may be personal data: they have the form
    of a kind, or a pattern takes them and a check fails."""
    taken = [any(a < y and x < b for _, x, y in base) for a, b in zip(found.starts, found.ends, strict=True)]
    for i, a in enumerate(found.starts):
        for j in range(i, min(i + 20, len(taken))):
            b = found.ends[j]
            if taken[j] or j > i and b - a > 64:
                break
            if not _MARK.search(text, a, b):
                continue
            if any(_formed(kind, text[slice(*_trimmed(kind, text, a, b))]) for kind in KINDS):
                return True
            part = text[a:b]
            if _IP.search(part) or _PHONE.search(part):
                return True
            if any(13 <= len(_digits(run)) <= 19 for run in _CARD.findall(part)):
                return True
    return False


# --- on tables --------------------------------------------------------------

#: Texts that may have base spans, in bounded steps; which have them is seen later.
_MAY_HAVE_BASE = (
    r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]{1,64}\.[A-Za-z0-9-]|[0-9]{1,3}(\.[0-9]{1,3}){3}"
    r"|[0-9]([ -]?[0-9]){15}|\+[0-9][ ().0-9-]{6}"
)


def labelled_words(docs: DataFrame) -> list[tuple[list[str], list[int]]]:
    """Shapes and labels of sequences of the corpus: of documents with marked words, half
    of them with forms of base spans and half without, those whose ids hash lowest
    (``TRAINING_DOCS``, whole), without doubtful sequences."""
    docs = texts(docs)
    marked = docs.where("doc_id is not null").where(F.col("text").rlike("[0-9@]"))
    with_base = F.col("text").rlike(_MAY_HAVE_BASE)
    ids = []
    for some in (marked.where(with_base), marked.where(~with_base)):
        ids += [row.doc_id for row in lowest(some.select("doc_id"), ["doc_id"], TRAINING_DOCS // 2).collect()]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                spans = base_spans(text)
                for n, found in enumerate(sequences(text)):
                    if len(found.shapes) <= TRAINING_WORDS and not _doubtful(text, found, spans):
                        rows.append((doc, n, found.shapes, labels_of(found, spans).tolist()))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "shapes", "labels"])

    if not ids:
        return []
    schema = "doc_id long, n long, shapes array<string>, labels array<long>"
    table = docs.where(F.col("doc_id").isin(ids)).mapInArrow(label, schema)
    table = settle(table, scratch_path(docs.sparkSession, "labelled-words"))
    return [(row.shapes, row.labels) for row in lowest(table, ["doc_id", "n"], TRAINING_SEQUENCES).collect()]


def fit(docs: DataFrame) -> Field:
    table = made_sequences() + labelled_words(docs)
    return train([features(shapes) for shapes, _ in table], [np.array(labels) for _, labels in table])


def spans_of(batch: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of some texts; all their sequences are decoded at once."""
    base = [base_spans(text) for text in batch]
    found = [sequences(text) for text in batch]
    flat = [features(sequence.shapes) for row in found for sequence in row]
    order = np.argsort([len(x) for x in flat], kind="stable")
    labels: list[np.ndarray] = [None] * len(flat)  # type: ignore[list-item]
    at = 0
    while at < len(order):
        # Like lengths together, and no more than about a million scores.
        size = max(1, min(len(order) - at, 50_000 // max(1, len(flat[order[at]]))))
        while size > 1 and size * len(flat[order[at + size - 1]]) > 200_000:
            size //= 2
        some = order[at : at + size]
        for i, row in zip(some, field.decode([flat[i] for i in some]), strict=True):
            labels[i] = row
        at += size
    out, n = [], 0
    for text, spans, row in zip(batch, base, found, strict=True):
        more: list[Span] = []
        held = _merged(spans)
        for sequence in row:
            more += added_spans(text, sequence, labels[n], held)
            n += 1
        out.append((spans, more))
    return out


def _text_of(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``(doc_id, text, base, spans)``; spans are written ``kind:start:end,...``
    in code points, by kind and start; ``spans`` holds the base ones too."""
    held = docs.sparkSession.sparkContext.broadcast(field or fit(docs))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = spans_of(batch.column(1).to_pylist(), held.value)
            columns = [pa.array([_text_of(a) for a, _ in found]), pa.array([_text_of(a + b) for a, b in found])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["doc_id", "text", "base", "spans"])

    return texts(docs).mapInArrow(find, "doc_id long, text string, base string, spans string")


def redacted(text: str, spans: str) -> str:
    """The text with each span, or run of overlapping spans, as ``[KIND]``."""
    places = []
    for item in spans.split(",") if spans else []:
        kind, a, b = item.split(":")
        places.append((int(a), int(b), kind.upper()))
    out, done = [], 0
    for a, b, kind in sorted(places, key=lambda x: (x[0], -x[1])):
        if a >= done:
            out += [text[done:a], f"[{kind}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """The documents with personal data replaced in ``text``; null texts stay null,
    and ``n_chars``, where there is one, follows a changed text."""
    held = docs.sparkSession.sparkContext.broadcast(field or fit(docs))
    names = docs.columns
    at = names.index("text")
    size_at = names.index("n_chars") if "n_chars" in names else None

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at):
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            found = spans_of([text or "" for text in old], held.value)
            new = [t and redacted(t, _text_of(a + b)) for t, (a, b) in zip(old, found, strict=True)]
            columns[at] = pa.array(new, columns[at].type)
            if size_at is not None:
                sizes = columns[size_at].to_pylist()
                sizes = [len(b) if a != b else n for a, b, n in zip(old, new, sizes, strict=True)]
                columns[size_at] = pa.array(sizes, columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(replace, docs.schema)
