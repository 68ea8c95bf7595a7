"""Personal data in texts: fixed patterns, and a linear-chain conditional random field beside them.

The patterns find mail addresses, network addresses, card numbers and telephone numbers that are
written as usual. The field finds others: numbers that run into the next one, that are broken by
other characters, or addresses that are spelled out. It labels the words of a line with the kinds of
data that begin or go on there, by features of a word's shape and of its neighbours' and by weights
of neighbouring labels; it is trained on a small table of labelled lines.

Decoding is Viterbi's, for all lines of a batch at once. A word whose features speak for "none" more
than any two neighbouring labels can speak against it has that label on the best path, so that lines
are cut there and only the words between are decoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import text_batches

KINDS = ("email", "ip", "card", "phone")
#: Label 0 is none; 2k+1 begins kind k, 2k+2 goes on with it.
LABELS = 1 + 2 * len(KINDS)
#: Labelled lines that the field is trained on, at most. They are the first by a hash.
FIT_ROWS = 5_000
#: The penalty on weights of neighbouring labels is so many times that on features.
ROUNDS, STEP, RIDGE, MOVES = 250, 0.3, 1e-3, 30
#: Words that are decoded together, and words whose features a task remembers. Speed only.
TOGETHER, REMEMBERED, REMEMBERED_CHARS = 1 << 18, 150_000, 32

Span = tuple[int, int]

# The patterns. A match begins at the first of a row of digits or not at all, so the expressions say
# so; they are otherwise those of the contract, in a form that takes time linear in the text.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(v * 2 - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str) -> list[Span]:
    """A local part ends in an @, so each is read backwards from there."""
    found, low, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        low = at + 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            low = match.end()
        at = text.find("@", low)
    return found


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]


def cards(text: str) -> list[Span]:
    found = []
    for match in _CARD.finditer(text):
        start, end = match.span()
        if 13 <= end - start <= 37:
            digits = _digits(match[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((start, end))
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]


PATTERNS = (emails, ips, cards, phones)


# Words and their features

_EDGES = re.compile(r"^[^\w+(]+|[^\w)]+$")
_SHAPE = re.compile(r"[0-9]+|[^\W\d_]+")
_NUMBER = re.compile(r"[0-9]+")
#: Letters of words that are features themselves, at most.
LETTERS = 12
_WORD = re.compile(rf"[^\W\d_]{{1,{LETTERS}}}")


def core(word: str) -> str:
    """A word without the marks around it."""
    return _EDGES.sub("", word)


def _run(match: re.Match) -> str:
    part = match[0]
    if not "0" <= part[0] <= "9":
        return "x"
    n = len(part)
    return str(n) if n <= 4 else "m" if n <= 8 else "n" if n <= 12 else "c" if n <= 19 else "l"


def features(word: str) -> list[str]:
    """Its shape (letters as x, rows of digits by their length or as 0), and some characters."""
    inner = core(word)[:80]
    shape = _SHAPE.sub(_run, inner)
    digits = sum("0" <= c <= "9" for c in inner)
    found = [f"shape {shape}", f"form {_NUMBER.sub('0', inner)}" if digits else "no digits", f"digits {min(digits, 20)}"]
    found += [f"has {c}" for c in "@+(.-" if c in inner]
    if _WORD.fullmatch(inner):
        found += ["letters", f"word {inner.lower()}"]
    return found


#: The feature of what stands before and after a line.
EDGE = "edge"
#: Ends a line among the words of a text.
LINE_END = "\0"


def words_of(text: str) -> list[str]:
    return text.replace("\0", "�").replace("\n", f" {LINE_END} ").split()


_SPOT = re.compile(r"\n|\S+")
_MARKED = re.compile(r"\[(email|ip|card|phone):(.*?)\]\]")


def labelled_words(line: str) -> tuple[list[str], list[int]]:
    """Words and labels of a line in which data stand as ``[kind:data]]``."""
    words, labels, end = [], [], 0
    for match in [*_MARKED.finditer(line), None]:
        plain = line[end : match.start() if match else None].split()
        words += plain
        labels += [0] * len(plain)
        if match:
            inner, kind = match[2].split(), KINDS.index(match[1])
            words += inner
            labels += [2 * kind + 1] + [2 * kind + 2] * (len(inner) - 1)
            end = match.end()
    return words, labels


@dataclass
class Field:
    """Weights by feature and place (before, at, after), of labels and of neighbouring labels."""

    index: dict[str, int]
    weights: np.ndarray
    steps: np.ndarray

    @property
    def surplus(self) -> np.ndarray:
        """What two neighbours can speak for each other label over none, at most."""
        into = (self.steps[:, 1:] - self.steps[:, :1]).max(0)
        onward = (self.steps[1:] - self.steps[:1]).max(1)
        return into + onward


def train(lines: Sequence[str]) -> Field:
    """Weights of greatest likelihood, with a penalty on their squares; the same for the same lines."""
    rows = [labelled_words(line) for line in sorted(lines)]
    steps = max((len(words) for words, _ in rows), default=0) + 2
    index: dict[str, int] = {EDGE: 0}
    for words, _ in rows:
        for word in words:
            for name in features(word):
                index.setdefault(name, len(index))
    size = len(index)
    at = np.zeros((len(rows), steps, size))
    gold = np.zeros((len(rows), steps), np.int64)
    forced = np.ones((len(rows), steps), bool)  # edges have no label
    for r, (words, labels) in enumerate(rows):
        at[r, 0, 0] = 1
        at[r, len(words) + 1 :, 0] = 1
        gold[r, 1 : len(words) + 1] = labels
        forced[r, 1 : len(words) + 1] = False
        for t, word in enumerate(words, 1):
            at[r, t, [index[name] for name in features(word)]] = 1
    near = np.zeros((len(rows), steps, 3 * size))
    near[:, 1:, :size] = at[:, :-1]
    near[:, :, size : 2 * size] = at
    near[:, :-1, 2 * size :] = at[:, 1:]
    flat = near.reshape(-1, 3 * size)
    chosen = np.eye(LABELS)[gold]
    pairs = np.einsum("rta,rtb->ab", chosen[:, :-1], chosen[:, 1:])

    weights, moves = np.zeros((3 * size, LABELS)), np.zeros((LABELS, LABELS))
    memory = [np.full_like(weights, 1e-4), np.full_like(moves, 1e-4)]
    for _ in range(ROUNDS if len(rows) else 0):
        scores = (flat @ weights).reshape(len(rows), steps, LABELS)
        scores[..., 1:][forced] = -1e4
        forth, back = np.zeros_like(scores), np.zeros_like(scores)
        forth[:, 0] = scores[:, 0]
        for t in range(1, steps):
            forth[:, t] = scores[:, t] + _log_sum(forth[:, t - 1, :, None] + moves, 1)
        for t in range(steps - 2, -1, -1):
            back[:, t] = _log_sum(moves + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        whole = _log_sum(forth[:, -1], 1)[:, None]
        marginal = np.exp(forth + back - whole[..., None])
        joint = forth[:, :-1, :, None] + moves + (scores + back)[:, 1:, None, :]
        joint = np.exp(joint - whole[..., None, None]).sum((0, 1))
        slopes = [
            flat.T @ (marginal - chosen).reshape(-1, LABELS) + RIDGE * len(rows) * weights,
            joint - pairs + MOVES * RIDGE * len(rows) * moves,
        ]
        for value, slope, seen in zip((weights, moves), slopes, memory):
            seen += slope**2
            value -= STEP * slope / np.sqrt(seen)
    return Field(index, weights.reshape(3, size, LABELS), moves)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis)) + most.squeeze(axis)


class Decoder:
    """Labels of words, under one field.

    Words with the same known features are a class; there are few classes, so that the scores of a
    word are a row of a small table.
    """

    def __init__(self, field: Field) -> None:
        self._field = field
        self._surplus = field.surplus + 1e-6
        self._classes: dict[tuple[int, ...], int] = {}
        self._rows: list[np.ndarray] = []
        self._known: dict[str, int] = {}
        self._edge = self._class_of([EDGE])
        #: Classes of words of letters that the field does not know, by length.
        self._letters = [self._class_of(features("x" * n)) for n in range(1, LETTERS + 2)]

    def _class_of(self, names: list[str]) -> int:
        own = tuple(sorted({self._field.index[n] for n in names if n in self._field.index}))
        if own not in self._classes:
            self._classes[own] = len(self._rows)
            self._rows.append(self._field.weights[:, list(own)].sum(1))
        return self._classes[own]

    def _classified(self, word: str) -> int:
        if word == LINE_END:
            return self._edge
        found = self._known.get(word)
        if found is None:
            inner = word if word[-1].isalpha() else word[:-1] if word[-1] in ".,!?" else ""
            if inner.isalpha() and f"word {inner.lower()}" not in self._field.index:
                found = self._letters[min(len(inner), LETTERS + 1) - 1]
            else:
                found = self._class_of(features(word))
            if len(word) <= REMEMBERED_CHARS:
                if len(self._known) >= REMEMBERED:
                    self._known.clear()
                self._known[word] = found
        return found

    def decode(self, words: list[str]) -> np.ndarray:
        """The label of each word; ``LINE_END`` separates lines."""
        known = self._known.get
        found = [known(word) for word in words]
        if None in found:
            found = [self._classified(word) if c is None else c for word, c in zip(words, found)]
        classes = np.array([self._edge, *found, self._edge], np.int64)
        before, own, after = np.array(self._rows).transpose(1, 0, 2)
        scores = own[classes]
        scores[1:] += before[classes[:-1]]
        scores[:-1] += after[classes[1:]]
        doubtful = (scores[:, 1:] + self._surplus).max(1) >= scores[:, 0]
        doubtful &= classes != self._edge
        labels = np.zeros(len(classes), np.int64)
        places = np.flatnonzero(doubtful)
        if len(places):
            cuts = np.flatnonzero(np.diff(places) > 1) + 1
            starts = places[np.append(0, cuts)]
            self._viterbi(scores, starts, places[np.append(cuts - 1, len(places) - 1)] + 1 - starts, labels)
        return labels[1:-1]

    def _viterbi(self, scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> None:
        """Label stretches that have none before and after, a step of all at a time."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        moves = self._field.steps
        best = scores[starts] + moves[0]
        chosen = []
        for t in range(1, int(lengths[0])):
            count = int(np.searchsorted(-lengths, -t, "left"))  # stretches longer than t
            ways = best[:count, :, None] + moves
            chosen.append(ways.argmax(1).astype(np.int8))
            best[:count] = ways.max(1) + scores[starts[:count] + t]
        last = (best + moves[:, 0]).argmax(1)
        for t in range(int(lengths[0]) - 1, -1, -1):
            count = int(np.searchsorted(-lengths, -t, "left"))
            labels[starts[:count] + t] = last[:count]
            if t:
                last[:count] = chosen[t - 1][np.arange(count), last[:count]]


_PLAUSIBLE_MAIL = re.compile(r"(?:@|\bat\b).*(?:\.|\bdot\b)", re.IGNORECASE | re.DOTALL)


def plausible(kind: int, text: str) -> bool:
    """Whether what the field found could be of that kind; the limits are the patterns' own."""
    digits = _digits(text)
    if KINDS[kind] == "email":
        return len(text) <= 320 and bool(_PLAUSIBLE_MAIL.search(text))
    if KINDS[kind] == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(_small, parts))
    if KINDS[kind] == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def _added(text: str, labels: np.ndarray) -> list[list[Span]]:
    """Spans of the labelled words, by kind."""
    spots = [m.span() for m in _SPOT.finditer(text.replace("\0", "�"))]
    found: list[list[Span]] = [[] for _ in KINDS]
    at = np.flatnonzero(labels).tolist()
    n = 0
    while n < len(at):
        begin, kind = at[n], (int(labels[at[n]]) - 1) // 2
        end = begin + 1
        while n + 1 < len(at) and at[n + 1] == end and labels[end] == 2 * kind + 2:
            n, end = n + 1, end + 1
        n += 1
        first, last = text[slice(*spots[begin])], text[slice(*spots[end - 1])]
        start = spots[begin][0] + len(first) - len(re.sub(r"^[^\w+(]+", "", first))
        stop = spots[end - 1][0] + len(re.sub(r"[^\w)]+$", "", last))
        if start < stop and plausible(kind, text[start:stop]):
            found[kind].append((start, stop))
    return found


def find_spans(texts: list[str], decoder: Decoder) -> list[list[dict]]:
    """Per text ``kind, start, end, base``, by kind, then start; ``base``: found by a pattern."""
    words = [words_of(text) for text in texts]
    joined = [word for own in words for word in (*own, LINE_END)]
    labels = decoder.decode(joined)
    out = []
    at = 0
    for text, own in zip(texts, words):
        base = [pattern(text) for pattern in PATTERNS]
        spans = [(kind, start, end, True) for kind, found in enumerate(base) for start, end in found]
        marked = labels[at : at + len(own)]
        at += len(own) + 1
        if marked.any():
            taken = sorted((start, end) for _, start, end, _ in spans)
            for kind, found in enumerate(_added(text, marked)):
                spans += [(kind, s, e, False) for s, e in found if not any(a < e and s < b for a, b in taken)]
        out.append([dict(kind=KINDS[k], start=s, end=e, base=b) for k, s, e, b in sorted(spans)])
    return out


def fit(labelled: DataFrame, text: str = "text", rows: int = FIT_ROWS) -> Field:
    """A field from at most ``rows`` lines of a labelled table, with data marked ``[kind:data]]``.

    Null lines take no part, repeated ones count once. The bound holds at every size.
    """
    lines = labelled.select(F.col(text).cast("string").alias("text")).where("text is not null").distinct()
    return train([r.text for r in lines.orderBy(F.xxhash64("text"), "text").limit(rows).collect()])


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group: list[str] = []
    size = 0
    for text in texts:
        if group and size + len(text) > 6 * TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def personal_data(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans``: ``kind, start, end, base`` of all personal data in every whole text.

    Spans count code points, the end exclusive, and come by kind (in the order of ``KINDS``), then
    start. ``base`` spans are the patterns' and overlap only those of other kinds; the field's are
    those that no pattern's touches and that could be of their kind.

    Null and empty texts have none. A row comes out for each row, whatever its key, its copies and
    its other columns. Nothing is shuffled; the field (under 1 MB) is a broadcast variable.
    """
    docs = text_batches(docs, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            texts = [value or "" for value in batch.column("text").to_pylist()]
            spans = [row for group in _groups(texts) for row in find_spans(group, decoder)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPANS)], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, spans array<struct<kind: string, start: bigint, `end`: bigint, base: boolean>>")
