import hashlib
import random
import re

import numpy as np
import pytest
from helpers import by_id, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import personal_data as P
from starloom.llm import personal_data_examples, queries

SF = "/root/testdata/sf0.001"

# The contract's own expressions.
SAID = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def said(kind, text):
    found = []
    for m in re.finditer(SAID[kind], text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        if kind == "ip" and max(map(int, m[0].split("."))) > 255:
            continue
        if kind == "phone" and not 9 <= len(digits) <= 15:
            continue
        if kind == "card":
            total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
            if not 13 <= len(digits) <= 19 or total % 10:
                continue
        found.append(m.span())
    return found


@pytest.fixture(scope="module")
def field():
    return P.train(personal_data_examples.LINES)


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text("a.@-%é ", max_size=40), st.text("0125.+ -()@a", max_size=60), st.text("4 -", min_size=10, max_size=50)))
def test_patterns_are_the_contracts(text):
    for kind, pattern in zip(P.KINDS, P.PATTERNS):
        assert pattern(text) == said(kind, text), kind


def test_cards_of_many_shapes():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789" * 6 + " -x") for _ in range(40))
        assert P.cards(text) == said("card", text)


def test_patterns_on_long_texts():
    """In time close to their length."""
    n = 1_000_000
    for text in ("a" * n, "1" * n, "1." * n, "1 " * n, "+1" * n, "+1" + "(" * n, "a@" * n, "a@a" + ".a" * n, "a@" + "." * n):
        assert [len(pattern(text)) for pattern in P.PATTERNS] == [1 if "a@a." in text else 0, n // 4 if text[:3] == "1.1" else 0, 0, 0]


def test_labels_of_the_table(field):
    decoder = P.Decoder(field)
    rows = [P.labelled_words(line) for line in personal_data_examples.LINES]
    right = sum(decoder.decode(words).tolist() == labels for words, labels in rows)
    assert right >= 0.97 * len(rows)


def test_lines_left_out_of_training():
    """Four times a fourth is left out: most words of data are still found, and little else."""
    lines = personal_data_examples.LINES
    pairs = []
    for k in range(4):
        decoder = P.Decoder(P.train([line for n, line in enumerate(lines) if n % 4 != k]))
        for words, labels in map(P.labelled_words, lines[k::4]):
            pairs += zip(labels, decoder.decode(words).tolist())
    data = [(a, b) for a, b in pairs if a]
    assert sum(a == b for a, b in data) >= 0.75 * len(data)
    assert sum(b > 0 for a, b in pairs if not a) <= 0.04 * (len(pairs) - len(data))


def _plain_viterbi(field, words):
    """Best labels of one line, with no cuts."""
    edge = [[P.EDGE]]
    names = edge + [P.features(w) for w in words] + edge
    at = [[field.index[n] for n in own if n in field.index] for own in names]
    scores = [
        sum(field.weights[1][i] for i in at[t]) + sum(field.weights[0][i] for i in at[t - 1]) + sum(field.weights[2][i] for i in at[t + 1])
        for t in range(1, len(words) + 1)
    ]
    best, ways = field.steps[0] + scores[0], []
    for score in scores[1:]:
        all_ways = best[:, None] + field.steps
        ways.append(all_ways.argmax(0))
        best = all_ways.max(0) + score
    label = int((best + field.steps[:, 0]).argmax())
    out = [label]
    for way in ways[::-1]:
        label = int(way[label])
        out.append(label)
    return out[::-1]


def test_cuts_change_nothing(field):
    rng = random.Random(6)
    stock = [w for line in personal_data_examples.LINES for w in P.labelled_words(line)[0]] + ["Thou", "xy,", "77", "é", "a1b2", "()"]
    decoder = P.Decoder(field)
    lines = [rng.choices(stock, k=rng.randint(1, 25)) for _ in range(600)]
    together = decoder.decode([w for line in lines for w in (*line, P.LINE_END)]).tolist()
    expected = [label for line in lines for label in (*_plain_viterbi(field, line), 0)]
    assert together == expected
    assert [decoder.decode(line).tolist() for line in lines] == [_plain_viterbi(field, line) for line in lines]


def test_gradient():
    """Training raises the likelihood of the labels over that of any other labelling."""
    field = P.train(["call [phone:+1 22]] now", "never mind"])
    words, labels = P.labelled_words("call [phone:+1 22]] now")
    assert _plain_viterbi(field, words) == labels
    assert P.Decoder(P.train([])).decode(["+1", "22"]).tolist() == [0, 0]


def test_what_the_patterns_miss(field):
    decoder = P.Decoder(field)
    texts = {
        "é on +1 (269) 555-3296 4524132264652876 and": ["card:23:39", "phone:5:22"],
        "+1!! (743)!! 555-3824!! the": ["phone:0:21"],
        "write to ann at mailbox dot org today": ["email:9:31"],
        "25.102.19.31 4116106959541135": ["ip:0:12", "card:13:29"],
        "x\n+1 (269)\n555-3296 y": [],
        "at home 4116106959541136 of 1.2.3.300": [],
        "a@b.c 10.0.0.1 4111 1111 1111 1111 +1 (212) 555-0188": ["email:0:5", "ip:6:14", "card:15:34", "phone:35:52"],
    }
    found = P.find_spans(list(texts), decoder)
    assert [[f"{s['kind']}:{s['start']}:{s['end']}" for s in own] for own in found] == list(texts.values())


def test_query(spark, field):
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ours = by_id(queries.op13_personal_data(spark, SF), *names)
    expected = []
    for r in rows:
        spans = {k: said(k, r.text or "") for k in SAID}
        text = ",".join(f"{k}:{a}:{b}" for k, found in spans.items() for a, b in found)
        expected.append((r.doc_id, *(len(s) for s in spans.values()), hashlib.sha256(text.encode()).hexdigest()))
    assert [r[:-1] for r in ours] == sorted(expected)
    assert sum(map(sum, (r[1:5] for r in ours))) > 5
    decoder = P.Decoder(field)
    spans = {r.doc_id: P.find_spans([r.text], decoder)[0] for r in rows}
    assert {r[0]: r[-1] for r in ours} == {
        i: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in own) for i, own in spans.items()
    }


def test_odd_rows(spark, field):
    rows = [(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "é 1.2.3.4\0 \0"), (5, "w " * 300_000 + "+1 (212) 555-0188"), (6, "\0\n\0")]
    found = P.personal_data(docs(spark, rows), field).collect()
    ours = sorted((r.doc_id or 0, [(s.kind, s.start, s.end, s.base) for s in r.spans]) for r in found)
    assert ours == [
        (0, [("ip", 2, 9, True)]), (1, []), (2, []), (3, [("email", 0, 6, True)]), (3, [("email", 0, 6, True)]),
        (5, [("phone", 600_000, 600_017, True)]), (6, []),
    ]
    assert P.personal_data(docs(spark, []), field).count() == 0


def test_fit_is_bounded_and_repeatable(spark):
    lines = [(line,) for line in personal_data_examples.LINES] + [(None,), (personal_data_examples.LINES[0],)]
    table = spark.createDataFrame(lines, "text string")
    a, b = P.fit(table), P.fit(table.repartition(5))
    assert np.array_equal(a.weights, b.weights)
    assert len(P.fit(table, rows=3).index) < len(a.index)
