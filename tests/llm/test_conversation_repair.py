"""Conversation repair against all possible edits, and against a plain walk over long conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from mercantil.llm import conversation_repair as repair
from mercantil.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, conv string, part int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], SCHEMA)


def faults(rows):
    """Rows in order with (fault, must go, truncated)."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    seen, out = set(), []
    for turn, role, text in order:
        kept = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not kept else "duplicate" if (role, text) in seen else
                 "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def brute_audit(rows):
    """Every sequence of edits with at most two insertions in a place, by definition."""
    best = None
    legal = re.compile(r"(s?(ua)+)?").fullmatch
    choices = []
    for _, role, text, fault in rows:
        edits = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            edits += [("K", more, (role, text))] + [("R", 2 + more, (r, text)) for r in ("user", "assistant")]
        choices.append(edits)
    gaps = [(), *itertools.product(("user",), repeat=1), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for edits in itertools.product(*choices):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            out, audit, cost = [], "", 0
            for k in range(len(rows) + 1):
                for role in inserts[k]:
                    out.append((role, ""))
                    audit += "I"
                    cost += 2
                if k < len(rows):
                    audit += edits[k][0]
                    cost += edits[k][1]
                    if edits[k][2]:
                        out.append(edits[k][2])
            if (best is None or (cost, audit) < best[:2]) and legal("".join(r[:1] or "_" for r, _ in out)):
                best = (cost, audit, out)
    return best


def walked_audit(rows):
    """The same by a table of states that holds whole strings."""
    state = {0: (0, "")}
    ahead = {0: 2, 1: 2, 2: 3, 3: 2}

    def better(table, key, value):
        if key not in table or value < table[key]:
            table[key] = value

    def spread(table):
        out = dict(table)
        for _ in range(2):
            for s, (cost, audit) in list(out.items()):
                better(out, ahead[s], (cost + 2, audit + "I"))
        return out

    for _, role, _, fault in rows:
        new = {}
        for s, (cost, audit) in spread(state).items():
            better(new, s, (cost + 3, audit + "D"))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                then = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((s, role[:1]))
                if then:
                    better(new, then, (cost + more, audit + "K"))
                better(new, ahead[s], (cost + 2 + more, audit + "R"))
        state = new
    ends = spread(state)
    return min(ends[s] for s in (0, 3) if s in ends)


def expected(rows, audit=None):
    own = faults(rows)
    cost, text = (audit or walked_audit)(own)[:2]
    count = lambda f: sum(r[3] == f for r in own)
    turns = [r[0] for r in own if r[0] is not None]
    initials = [r[1][:1] for r in own]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    lines = repair.repaired([(r[1].encode(), r[2].encode()) for r in own], text)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1].decode() for r, _ in lines))
    sha = hashlib.sha256(b"\n".join(r + b":" + t for r, t in lines)).hexdigest()
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, text, sha)


def some_rows(rng, size):
    rows = []
    for k in range(size):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
        text = rng.choice(["Yes.", "No!", "open", " \t", "", "Why? ", "a.b", "é?"])
        rows.append((rng.choice([k, k, k + 1, None, 3 * k]), role, text))
    return rows


def test_audits_equal_every_edit():
    rng = random.Random(2)
    for _ in range(60):
        rows = faults(some_rows(rng, rng.randint(0, 3)))
        cost, audit, out = brute_audit(rows)
        assert walked_audit(rows) == (cost, audit)
        audits = repair.Audits()
        vector = [(0, 0), None, None, None]
        for _, role, _, fault in rows:
            vector = repair.advanced(audits, vector, role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        assert repair.accepted(audits, vector) == (cost, audit)
        lines = repair.repaired([(r[1].encode(), r[2].encode()) for r in rows], audit)
        assert [(r.decode(), t.decode()) for r, t in lines] == out


@pytest.mark.parametrize("prime", [repair.PRIME, 3])
def test_comparison_of_audits(monkeypatch, prime):
    """With a hash of three values nearly every comparison is misled and must be verified."""
    monkeypatch.setattr(repair, "PRIME", prime)
    rng = random.Random(5)
    audits, nodes = repair.Audits(), [0]
    for _ in range(300):
        nodes.append(audits.add(rng.choice(nodes), "".join(rng.choices("DIKR", k=rng.randint(1, 4)))))
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert audits.less(a, b) == (audits.spell(a) < audits.spell(b))


def odd_rows():
    rng = random.Random(9)
    rows = [(conv, *r) for conv in range(120) for r in some_rows(rng, rng.randint(1, 9))]
    rows += [(200, t, r, x) for t, r, x in some_rows(rng, 400)]
    rows += [(None, t, r, x) for t, r, x in some_rows(rng, 5)]
    rows += [(201, 1, "user", "same.")] * 40 + [(201, 2, "assistant", "same.")] * 3
    rows += [(202, k, "user", "again.") for k in range(60)]
    rows += [(203, None, None, None), (203, 5, "user", None), (204, 1, "user", "long " * 50_000 + ".")]
    return rows


def by_conversation(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return groups


@pytest.mark.parametrize("size", [repair.SEGMENT_ROWS, 3])
def test_reports(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", size)
    rows = odd_rows()
    random.Random(1).shuffle(rows)
    reports, turns = repair.repair(frame(spark, rows))
    found = {r.conv_id: tuple(r)[1:] for r in reports.collect()}
    wanted = {conv: expected(own) for conv, own in by_conversation(rows).items()}
    assert reports.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found == wanted and len(found) == reports.count()
    lines = {}
    for r in sorted(turns.collect(), key=lambda r: (r.piece, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, own in wanted.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == own[-1]
    assert repair.repair(frame(spark, []))[0].count() == 0


def test_query(spark, tmp_path):
    rows = odd_rows() + [(conv, 0, "user", "Lost.") for conv in range(1000, 1060)]
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    damaged = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = queries.op12_conversation_repair(spark, str(tmp_path))
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == {
        conv: expected(own) if own else (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) for conv, own in damaged.items()}
    assert any(not own for own in damaged.values())
