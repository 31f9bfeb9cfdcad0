import hashlib
import itertools
import random
import re
import zlib

import pytest
from compare import of_spark, of_sql

from fernweave.llm import conversation_repair as R

SHAPE = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """(cost, audit, repaired rows) by trying edits in the order of their cost; rows are (role, text, must go, truncated)."""
    limit = 4 * len(rows)
    found = []

    def go(i, cost, audit, out):
        if cost > limit:
            return
        if i == len(rows) and SHAPE.fullmatch("".join(r[:1] for r, _ in out)):
            found.append((cost, audit, out))
        for role in ("user", "assistant"):
            if cost + 3 <= limit and (not out or out[-1][0] != role):
                go(i, cost + 3, audit + "I", [*out, (role, "")])
        if i < len(rows):
            role, text, gone, cut = rows[i]
            go(i + 1, cost + 4, audit + "D", out)
            if not gone:
                if role[:1] in ("s", "u", "a"):
                    go(i + 1, cost + 3 * cut, audit + "K", [*out, (role, text)])
                for other in ("user", "assistant"):
                    go(i + 1, cost + 3 + 3 * cut, audit + "R", [*out, (other, text)])

    go(0, 0, "", [])
    cost, audit = min((c, a) for c, a, _ in found)
    outs = {tuple(o) for c, a, o in found if (c, a) == (cost, audit)}
    assert len(outs) == 1
    return cost, audit, outs.pop()


def letters(rows):
    out = ""
    for role, _, gone, cut in rows:
        c = role[:1] if role[:1] in ("s", "u", "a") else "x"
        out += "d" if gone else c.upper() if cut else c
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_parses_of_all_short_conversations(n):
    kinds = [(role, "t", gone, cut) for role in ("system", "user", "assistant", "tool") for gone, cut in ((False, False), (False, True))] + [("user", "", True, False)]
    for rows in itertools.product(kinds, repeat=n):
        assert R.best(R.parse(letters(rows), "Begin")) == brute(rows)[:2]


def test_random_longer_conversations_and_pieces():
    draw = random.Random(3)
    for _ in range(150):
        rows = [(draw.choice(["system", "user", "user", "assistant", "assistant", ""]), "t", draw.random() < 0.2, draw.random() < 0.3) for _ in range(draw.randint(4, 5))]
        text = letters(rows)
        expected = brute(rows)[:2]
        assert R.best(R.parse(text, "Begin")) == expected
        cut = draw.randint(0, len(text))
        found = R.all_composed([R.piece(text[:cut]), R.piece(text[cut:]), R.piece("")])
        assert R.best({q: w for (p, q), w in found.items() if p == "Begin"}) == expected


def test_pieces_of_long_conversations():
    draw = random.Random(4)
    text = "".join(draw.choice("suauauadxSUA") for _ in range(300))
    found = R.all_composed([R.piece(text[i : i + 37]) for i in range(0, len(text), 37)])
    assert R.best({q: w for (p, q), w in found.items() if p == "Begin"}) == R.best(R.parse(text, "Begin"))


def plain(rows):
    """The query's rows for (conv_id, turn, role, text), conversation by conversation."""
    out, damaged = [], {}
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if h == 4 else role
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        damaged.setdefault(conv, []).extend([(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1))
    for conv, found in damaged.items():
        def key(r, conv=conv):
            name = "" if conv is None else f"={conv}"
            told = f"{len(name)}:{len(r[1])}:{name}{r[1]}{r[2]}"
            return r[0] is not None, r[0] or 0, r[1], hashlib.sha256(told.encode()).digest()[:16]

        found.sort(key=key)
        turns = [t for t, *_ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults, marked = set(), dict(blank=0, duplicate=0, truncated=0), []
        for _, role, text in found:
            body = text.strip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [r[:1] for _, r, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        if len(marked) <= 4:
            cost, audit, repaired = brute(marked)
        else:
            cost, audit = R.best(R.parse(letters(marked), "Begin"))  # compared with brute force above
            repaired = replay(marked, audit)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def replay(marked, audit):
    """Repaired rows by an audit: roles alternate after an optional system row."""
    rows, out = iter(marked), []
    for edit in audit:
        role, text, *_ = next(rows) if edit != "I" else ("", "")
        said = sum(r[:1] != "s" for r, _ in out) % 2
        if edit == "K":
            out.append((role, text))
        elif edit != "D":
            out.append((("user", "assistant")[said], text))
    assert next(rows, None) is None and SHAPE.fullmatch("".join(r[:1] for r, _ in out))
    return out


def sort(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


ODD = [
    (1, 0, "user", "Hello."), (1, 0, "user", "Hello."), (1, 1, None, None), (1, None, "assistant", "no turn"), (1, None, "system", "Be good."),
    (None, 0, "user", "a null id"), (None, None, None, None), (2, 5, "assistant", " \n\t"), (3, 0, "", "an empty role."), (3, 1, "tool", "x?"),
    (4, 0, "user", "é 한글 😀 "), (4, 9, "assistant", "Long. " * 50_000), (5, -3, "USER", "upper."), (5, 7, "user", "tie b."), (5, 7, "user", "tie a."),
    *[(i, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 3}.") for i in range(10, 60) for t in range(i % 7)],
]


def test_query_on_odd_rows_equals_brute_force(spark, folder):
    got = [tuple(r) for r in R.op12_conversation_repair(spark, folder(conversations=ODD)).collect()]
    assert sort(got) == sort(plain(ODD))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = R.op12_conversation_repair(spark, "/root/testdata/sf0.01")
    assert got.columns == ["conv_id", *R.NUMBERS, "audit", "repaired_sha256"]
    assert sort(tuple(r) for r in got.collect()) == sort(plain(rows))


@pytest.mark.parametrize("data", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, data):
    assert of_spark(R.op12_conversation_repair(spark, data)) == of_sql(R.ORACLE, data)


def test_sql_on_odd_rows(spark, folder):
    rows = [r for r in ODD if r[:2] != (5, 7)]  # rows of one turn stand by role and text there
    at = folder(conversations=rows)
    assert of_spark(R.op12_conversation_repair(spark, at)) == of_sql(R.ORACLE, at)


def test_a_conversation_over_many_partitions(spark, monkeypatch):
    """One conversation with most rows is cut into pieces, over partitions and inside these."""
    monkeypatch.setattr(R, "PIECE", 16)
    draw = random.Random(6)
    rows = [(7, t, draw.choice(["user", "assistant", "system", "x"]), draw.choice(["a.", "b", "", f"t{t}.", f"t{t}"])) for t in range(400)]
    rows += [(i, t, "user", f"{i} {t}.") for i in range(5) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = R.repaired(R.damaged(df), n=R.F.col("copies"), digest=True).collect()
    assert sort(tuple(r) for r in got) == sort(plain(rows))


def test_texts_and_clashing_columns(spark):
    rows = [("c", 0, "user", "Hi", 1, "x"), ("c", 1, "user", "Hi.", 2, "y")]
    df = spark.createDataFrame(rows, "conv string, n long, role string, kind string, key long, audit string")
    out = R.repaired(df, "conv", "n", "role", "kind")
    assert out.columns == ["conv", *R.NUMBERS, "audit", "repaired"]
    assert tuple(out.first()) == ("c", 0, 0, 0, 1, 1, 6, "KR", "user:Hi\nassistant:Hi.")


def test_no_rows(spark, folder):
    assert R.op12_conversation_repair(spark, folder(conversations=[])).count() == 0
