import random
import re
from collections import Counter

import duckdb

from starloom.llm import oracle, queries, quotation

COLUMNS = ["conv_id", "thread", "depth", "turn", "role", "reply_to", "n_quotes", "n_linked", "n_copies", "text"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, thread string, message int"


def norm(text):
    return re.sub(r"[ \t\r\n]+", " ", text.lower()).strip(" ")


def parse(text):
    """Own text and quoted passages (level, text) of a message."""
    if text is None or not re.search(r"(^|\n)[ \t]*>", text):
        return text, []
    own, passages, last = [], [], None
    for line in text.split("\n"):
        marks = re.match(r"[ \t>]*", line)[0]
        level = marks.count(">")
        content = line[len(marks) :] if level else line
        if level == 0:
            own.append(content)
        elif level == last:
            passages[-1][1].append(content)
        else:
            passages.append((level, [content]))
        last = level
    return re.sub(r"^\n+|\n+$", "", "\n".join(own)), [(n, "\n".join(x)) for n, x in passages]


def brute(rows):
    messages = Counter(rows)
    first, parsed = {}, {m: parse(m[3]) for m in messages}
    for m in messages:
        own = parsed[m][0]
        if m[0] is None or m[1] is None or own is None:
            continue
        for unit in [own, *re.split(r"\n[ \t\r]*\n", own), *own.split("\n")]:
            if unit := norm(unit):
                first.setdefault((m[0], unit), []).append(m)
    parents, linked = {}, Counter()
    for m in messages:
        found = []
        for level, text in parsed[m][1]:
            if m[0] is None or m[1] is None or not norm(text):
                continue
            originals = first.get((m[0], norm(text)), [])
            turn = min((o[1] for o in originals), default=None)
            if turn is not None and turn < m[1]:
                linked[m] += 1
                if level == 1:
                    found.append((turn, [o for o in originals if o[1] == turn]))
        if found:
            parents[m] = max(found, key=lambda x: x[0])
    out = []
    for m, copies in messages.items():
        depth, at = 0, m
        while at in parents:
            depth, at = depth + 1, parents[at][1][0]
        out.append((m[0], at[1], depth, m[1], m[2], parents[m][0] if m in parents else None,
                    len(parsed[m][1]), linked[m], copies, parsed[m][0]))
    return _sorted(out)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def found(spark, rows):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(3)
    return _sorted(tuple(r) for r in quotation.reply_ordered(df).select(*COLUMNS).collect())


def conversations(seed):
    """Replies that quote earlier messages, their paragraphs or lines, nested too; unique turns."""
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choices("Ab cd eF gh ij".split(), k=rng.randint(1, 9)))
    rows = []
    for conv in range(8):
        texts = []
        for turn in range(rng.randint(1, 12)):
            body = "\n".join(rng.choice([line(), line(), "", line() + " > x"]) for _ in range(rng.randint(1, 4)))
            if texts and rng.random() < 0.7:
                source = rng.choice(texts)
                part = rng.choice([source, *source.split("\n\n"), *source.split("\n")])
                quoted = "\n".join(rng.choice(["> ", ">", " > "]) + x.swapcase() for x in part.split("\n"))
                body = rng.choice([quoted + "\n\n" + body, body + "\n" + quoted, body + "\n" + quoted + "\n" + body])
            texts.append(body)
            rows.append((conv, turn, rng.choice(["user", "assistant"]), body))
    return rows


def test_against_one_message_at_a_time(spark):
    rows = conversations(1) + conversations(1)[:20]
    expected = brute(rows)
    assert max(r[2] for r in expected) > 1
    assert found(spark, rows) == expected


def test_sql_says_the_same(spark):
    rows = conversations(2) + [(99, 0, None, None), (99, 1, "user", ">"), (99, 2, "user", "> >\n>>> x")]
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    cursor = db.execute(oracle.all_sql()["op6_quotation"])
    names = [d[0] for d in cursor.description]
    theirs = [dict(zip(names, r)) for r in cursor.fetchall()]
    assert _sorted(tuple(r[c] for c in COLUMNS) for r in theirs) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (1, 0, "user", ""), (1, 1, "user", None), (1, None, "user", "> a"), (None, 2, "user", "> a"),
        (2, 0, "user", "a"), (2, 1, "user", "> a"), (2, 1, "user", "> a"), (2, 2, "user", ">a\n>> a\n>\n> no such"),
        (2, 3, None, "\n>> a\n\nown\n> \n"), (3, 0, "user", "> later"), (3, 1, "user", "later"),
        (4, 0, "user", "w " * 50_000), (4, 1, "user", "> " + "w " * 50_000 + "\nyes"), (4, 2, "user", ">" * 20_000 + " yes"),
        (5, 0, "user", "\n".join(f"l{i}" for i in range(20_000))), (5, 1, "user", "> l19999"),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_trimmed_quotations(spark):
    """(reply_to, n_quotes, n_linked, thread) of replies that quote part of a message."""
    three = "One line,\nanother line,\na third line.\n\nA middle.\n\nThe end\nof it."
    quote = lambda text: "\n".join("> " + x for x in text.split("\n"))
    replies = {
        "One line,\nanother line,": (1, 1, 1, 1),  # two lines of a paragraph
        "another line,\na third line.": (1, 1, 1, 1),
        "a middle.\n\nThe end  of it.": (1, 1, 1, 1),  # two paragraphs of three, wrapped in another way
        "One line,\n[...]\nof it.": (1, 1, 1, 1),
        "Hello\nA middle.": (1, 1, 1, 1),  # Hello is said before, by another
        "no such\nlines": (None, 1, 0, 3),
        "[...]\n--": (None, 1, 0, 3),  # nothing to tell a message by, though one has such lines
        "later on\nand on": (None, 1, 0, 3),  # only a later message has these
    }
    rows = []
    for conv, text in enumerate(replies):
        rows += [(conv, 0, "user", "Hello\n--\n[...]\n--"), (conv, 1, "assistant", three), (conv, 2, "user", "--")]
        rows += [(conv, 3, "user", quote(text) + "\nYes."), (conv, 4, "user", "later on\nand on\nmore")]
    nested = f">{quote('One line,' + chr(10) + 'another line,')}\n> Yes.\nNo."
    rows += [(99, 0, "user", three), (99, 1, "user", quote("A middle.") + "\nYes."), (99, 2, "user", nested)]
    got = {(r[0], r[3]): (r[5], r[6], r[7], r[1]) for r in found(spark, rows)}
    assert [got[conv, 3] for conv in range(len(replies))] == list(replies.values())
    assert got[99, 2] == (1, 2, 2, 0)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op6_quotation(spark, sf).collect()
    assert _sorted(tuple(r[c] for c in COLUMNS) for r in got) == brute(rows)
    assert all(r.formatted == f"<|{r.role}|>\n{r.text}\n" for r in got)


def test_long_runs_of_line_breaks(spark):
    n = 300_000
    text = "> " + "\n" * n + "a" + "\n" * n + "b" + "\n" * n
    rows = [(1, 0, "user", "a"), (1, 1, "user", text)]
    assert sorted(len(r[-1]) for r in found(spark, rows)) == [1, n + 2]
