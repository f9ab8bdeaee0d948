"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field is trained on a small table labelled by hand (`pii_labels`), and
its Viterbi decoding (numpy, all stretches of a batch at once) adds spans that the patterns miss, such as
numbers written in another way. A tag other than "outside" is allowed only within `REACH` words of a word
with a digit or an @; the chain is "outside" everywhere else, so stretches are decoded on their own and
the result is that of decoding the whole text. A span is cut to its entity and held against what its kind
cannot be (`sound`), so that no card failing Luhn and no address with a part over 255 comes back as one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import clean_text
from shelfmark.llm.pii_labels import LINES, parse
from shelfmark.llm.wordhash import slices

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *[f"{p}-{k}" for k in KINDS for p in ("B", "I")])
REACH = 3

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[int, int]


def emails(text: str) -> Iterator[Span]:
    """Local part, @, and a domain of two labels or more; linear in the text."""
    done = 0
    for run in LOCAL.finditer(text):
        begin, at = max(run.start(), done), run.end()
        if begin < at and (domain := DOMAIN.match(text, at)):
            done = domain.end()
            yield begin, done


def addresses(text: str) -> Iterator[Span]:
    """Four numbers joined by dots, each at most 255."""
    for chain in DOTTED.finditer(text):
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def base_spans(text: str) -> dict[str, list[Span]]:
    digit = any(d in text for d in "0123456789")
    return {
        "email": list(emails(text)) if "@" in text else [],
        "ip": list(addresses(text)) if digit and "." in text else [],
        "card": list(cards(text)) if digit else [],
        "phone": list(phones(text)) if digit and "+" in text else [],
    }


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{b}:{e}" for k in KINDS for b, e in sorted(spans[k]))


def stretches(text: str) -> Iterator[list[Span]]:
    """Runs of words within REACH words of a trigger."""
    if not TRIGGER.search(text):
        return
    words = [m.span() for m in WORD.finditer(text)]
    run: list[Span] = []
    until = -1
    hits = [i for i, (b, e) in enumerate(words) if TRIGGER.search(text, b, e)]
    for i in hits:
        begin = max(i - REACH, 0)
        if run and begin > until:
            yield run
            run = []
        begin = max(begin, until)
        until = min(i + REACH + 1, len(words))
        run.extend(words[begin:until])
    if run:
        yield run


class _Signs(dict):
    """The class of a character: digit, capital, letter, or itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = "9" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c
        return self[code]


SIGNS = _Signs()
REPEATED = re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """Classes of the word's characters, runs of one class as one sign; a digest of a long one."""
    out = REPEATED.sub(r"\1", word.translate(SIGNS))
    return out if len(out) <= 24 else hashlib.blake2b(out.encode("utf-8", "replace"), digest_size=8).hexdigest()


def features(words: Sequence[str]) -> list[list[str]]:
    """Shape features of every word and of its neighbours, and the neighbours themselves."""
    shapes = [shape(w) for w in words]
    around = ["^", *shapes, "$"]
    named = ["^", *(w.strip(".,;:!?").lower() if len(w) <= 24 else "" for w in words), "$"]
    out = []
    for i, w in enumerate(words):
        digits = sum("0" <= c <= "9" for c in w)
        edges = w.strip(".,;:!?")
        out.append([
            f"s={shapes[i]}", f"p={around[i]}", f"n={around[i + 2]}", f"d={min(digits, 20)}",
            f"sd={shapes[i]}/{min(digits, 20)}", f"sp={shapes[i]}/{around[i]}", f"sn={shapes[i]}/{around[i + 2]}",
            f"f={edges[:1] if not edges[:1].isalnum() else shapes[i][:1]}", f"l={min(len(w), 24)}",
            f"pw={named[i]}", f"nw={named[i + 2]}", f"pd={min(sum('0' <= c <= '9' for c in words[i - 1]), 5) if i else -1}",
        ])
    return out


ALLOWED = np.array([[not b.startswith("I") or a[1:] == b[1:] for b in TAGS] for a in TAGS])
FIRST = np.array([not t.startswith("I") for t in TAGS])


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


@dataclass
class Field:
    """Weights of shape features by tag, and of tag pairs."""

    index: dict[str, int]
    weight: np.ndarray
    step: np.ndarray

    def rows(self, words: Sequence[str]) -> np.ndarray:
        unknown = len(self.index)
        return np.array([[self.index.get(f, unknown) for f in fs] for fs in features(words)], np.int64)

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi over sequences of feature rows; sequences of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            group = order[at:at + 512]
            # Padding is at most as long as the shortest of the group, whatever the longest is.
            group = [i for i in group if len(sequences[i]) <= 2 * len(sequences[group[0]])]
            at += len(group)
            longest = len(sequences[group[-1]])
            score = np.zeros((len(group), longest, len(TAGS)))
            for row, i in enumerate(group):
                score[row, :len(sequences[i])] = self.weight[sequences[i]].sum(1)
            step = np.where(ALLOWED, self.step, -1e9)
            best = score[:, 0] + np.where(FIRST, 0, -1e9)
            back = np.zeros((len(group), longest, len(TAGS)), np.int8)
            ends = np.array([len(sequences[i]) for i in group])
            final = best.copy()
            for t in range(1, longest):
                paths = best[:, :, None] + step
                back[:, t] = paths.argmax(1)
                best = paths.max(1) + score[:, t]
                final[ends > t] = best[ends > t]
            for row, i in enumerate(group):
                tags = np.zeros(ends[row], np.int64)
                tags[-1] = final[row].argmax()
                for t in range(ends[row] - 1, 0, -1):
                    tags[t - 1] = back[row, t, tags[t]]
                out[i] = tags
        return out


def train_field(table: list[tuple[list[str], list[int]]], rounds: int = 60, rate: float = 0.3, ridge: float = 1e-3) -> Field:
    """Field trained on (words, tags) by full gradient steps on the conditional likelihood."""
    index: dict[str, int] = {}
    for words, _ in table:
        for fs in features(words):
            for f in fs:
                index.setdefault(f, len(index))
    field = Field(index, np.zeros((len(index) + 1, len(TAGS))), np.zeros((len(TAGS), len(TAGS))))
    data = [(field.rows(w), np.array(t)) for w, t in table if w]
    if not data:
        field.weight[:, 0] = 1.0
        return field
    longest = max(len(t) for _, t in data)
    width = data[0][0].shape[1]
    rows = np.full((len(data), longest, width), len(index))
    gold = np.zeros((len(data), longest), np.int64)
    mask = np.zeros((len(data), longest), bool)
    for i, (r, t) in enumerate(data):
        rows[i, :len(t)], gold[i, :len(t)], mask[i, :len(t)] = r, t, True
    target = np.zeros((len(data), longest, len(TAGS)))
    np.put_along_axis(target, gold[:, :, None], 1, 2)
    target *= mask[:, :, None]
    pairs = np.zeros_like(field.step)
    np.add.at(pairs, (gold[:, :-1][mask[:, 1:]], gold[:, 1:][mask[:, 1:]]), 1)
    first = np.where(FIRST, 0, -1e9)
    seen = [np.zeros_like(field.weight), np.zeros_like(field.step)]
    flat = rows[mask]
    for _ in range(rounds):
        score = field.weight[rows].sum(2)
        step = np.where(ALLOWED, field.step, -1e9)
        ahead = np.zeros_like(score)
        behind = np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + first
        for t in range(1, longest):
            moved = _logsum(ahead[:, t - 1][:, :, None] + step, 1) + score[:, t]
            ahead[:, t] = np.where(mask[:, t, None], moved, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = _logsum(step[None] + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(mask[:, t + 1, None], moved, 0)
        total = _logsum(ahead[:, -1], 1)
        chance = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        expected = np.zeros_like(field.step)
        for t in range(1, longest):
            live = mask[:, t]
            if live.any():
                joint = ahead[live, t - 1][:, :, None] + step + (score[live, t] + behind[live, t])[:, None, :] - total[live][:, None, None]
                expected += np.exp(joint).sum(0)
        error = (target - chance)[mask]
        gradient = np.zeros_like(field.weight)
        for k in range(width):
            np.add.at(gradient, flat[:, k], error)
        gradient[-1] = 0
        for value, slope, square in ((field.weight, gradient / len(data) - ridge * field.weight, seen[0]),
                                     (field.step, (pairs - expected) / len(data) - ridge * field.step, seen[1])):
            square += slope**2
            value += rate * slope / (np.sqrt(square) + 1e-8)
    return field


def tag_words(spans: dict[str, list[Span]], words: list[Span]) -> list[int]:
    """Tags of words by the spans they overlap."""
    flat = sorted((b, e, k) for k, found in spans.items() for b, e in found)
    tags, i = [], 0
    previous = None
    for b, e in words:
        while i < len(flat) and flat[i][1] <= b:
            i += 1
        if i < len(flat) and flat[i][0] < e:
            tags.append(TAGS.index(("I-" if previous == flat[i] else "B-") + flat[i][2]))
            previous = flat[i]
        else:
            tags.append(0)
            previous = None
    return tags


def labelled_table(lines: Sequence[str] = LINES) -> list[tuple[list[str], list[int]]]:
    """Words and tags of the labelled lines, as many and as long as the stretches that are decoded."""
    table = []
    for text, spans in map(parse, lines):
        for run in stretches(text):
            table.append(([text[b:e] for b, e in run], tag_words(spans, run)))
    return table


#: The entity inside the words of a span: what may stand at its ends.
ENTITY = {"email": re.compile(r"[^\W_].*[^\W_]", re.DOTALL), "ip": re.compile(r"[0-9].*[0-9]", re.DOTALL),
          "card": re.compile(r"[0-9].*[0-9]", re.DOTALL), "phone": re.compile(r"[+(]?[0-9].*[0-9]", re.DOTALL)}
DIGITS = re.compile(r"[0-9]+")


def sound(kind: str, part: str) -> bool:
    """What the kind demands, however it is written."""
    numbers = DIGITS.findall(part)
    digits = "".join(numbers)
    if kind == "email":
        return part.count("@") == 1
    if kind == "ip":
        return len(numbers) == 4 and all(len(n.lstrip("0")) <= 3 and int(n.lstrip("0") or 0) <= 255 for n in numbers)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    # Four numbers up to 255 between dots are an address, or fail as one; so is a long number that fails as a card.
    return 7 <= len(digits) <= 15 and not re.fullmatch(r"[0-9]+(\.[0-9]+){3}", part)


def added_spans(texts: list[str], base: list[dict[str, list[Span]]], field: Field) -> list[dict[str, list[Span]]]:
    """Spans that the field finds and no base span overlaps."""
    out: list[dict[str, list[Span]]] = [{k: [] for k in KINDS} for _ in texts]
    places, rows = [], []
    for i, text in enumerate(texts):
        for run in stretches(text):
            places.append((i, run))
            rows.append(field.rows([text[b:e] for b, e in run]))
    for (i, run), tags in zip(places, field.decode(rows)):
        at = 0
        while at < len(tags):
            name = TAGS[tags[at]]
            end = at + 1
            if name != "O":
                while end < len(tags) and TAGS[tags[end]] == "I" + name[1:]:
                    end += 1
                b, e = run[at][0], run[end - 1][1]
                if entity := ENTITY[name[2:]].search(texts[i], b, e):
                    b, e = entity.span()
                    if sound(name[2:], texts[i][b:e]) and not any(x < e and b < y for found in base[i].values() for x, y in found):
                        out[i][name[2:]].append((b, e))
            at = end
    return out


def find_personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and digest are of the base spans; `spans` holds all. Positions are code points. A null or
    empty text has no span, a null doc_id is reported like any other, repeated rows are reported each,
    an empty table gives an empty result, and other columns are ignored.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = batch.column(1).to_pylist()
            base = [base_spans(t) for t in texts]
            added = added_spans(texts, base, field)
            both = [{k: b[k] + a[k] for k in KINDS} for b, a in zip(base, added)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([len(b[k]) for b in base], pa.int64()) for k in KINDS],
                 pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([listed(b) for b in both], pa.string()),
                 pa.array([sum(map(len, a.values())) for a in added], pa.int64())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    kind = dict(docs.dtypes)["doc_id"]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", clean_text().alias("_t")).mapInArrow(
        find, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_added bigint")
