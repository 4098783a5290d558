"""Conversation repair against a left-to-right search, and against all edits of short conversations."""

import hashlib
import random
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from ouvidoria.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, cost int, part string"
SPACE = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}


def good(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return not initials or (len(rest) > 0 and len(rest) % 2 == 0 and all(c == "ua"[i % 2] for i, c in enumerate(rest)))


def fault_list(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def best_by_hand(rows, faults):
    """Least (cost, audit, lines): prefixes by (rows used, initials so far, reduced to what matters)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    states = {"": (0, "", ())}

    def inserted(states):
        states = dict(states)
        for _ in range(4):
            for s, (cost, audit, lines) in list(states.items()):
                for r in "ua":
                    if (s, r) in step:
                        new = (cost + 2, audit + "I", (*lines, f"{NAMES[r]}:"))
                        t = step[s, r]
                        states[t] = min(states.get(t, new), new)
        return states

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for s, (cost, audit, lines) in inserted(states).items():
            options = [(s, cost + 3, audit + "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if (s, role[:1]) in step:
                    options.append((step[s, role[:1]], cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                for r in "ua":
                    if (s, r) in step:
                        options.append((step[s, r], cost + 2 + extra, audit + "R", (*lines, f"{NAMES[r]}:{text}")))
            for t, *found in options:
                new[t] = min(new.get(t, tuple(found)), tuple(found))
        states = new
    states = inserted(states)
    return min(states[s] for s in ("", "a") if s in states)


def report_by_hand(conv_id, rows):
    faults = fault_list(rows)
    cost, audit, lines = best_by_hand(rows, faults)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha


def ordered(rows):
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))


def reports_by_hand(rows, damage=False):
    convs = {}
    for c, t, role, text in rows:
        held = convs.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
        text = "" if fate == 1 else text.translate({ord(x): None for x in ".!?"}) if fate == 2 else text
        held += [(t, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return sorted((report_by_hand(c, ordered(r)) for c, r in convs.items()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    roles = ["user", "assistant", "system", "tool", "usher", None, ""]
    texts = ["Hello.", "Hello.", "What?", "no end", " \t\n", "", None, "So!\n", "é. ", "x" * 5000 + ".", "　", "Well. ", "a.b"]
    out = []
    for c in range(150):
        for t in range(rng.randrange(1, 9)):
            weights = (6, 6, 2, 1, 1, 1, 1) if c % 3 else (20, 20, 1, 0, 0, 0, 0)
            out.append((c, rng.choice([t, t, t, t + 3, None]), rng.choices(roles, weights)[0], rng.choice(texts)))
    out += [(None, t, ("user", "assistant")[t % 2], f"t{t}.") for t in range(6)]
    out += [(500, t, rng.choice(roles[:3]), rng.choice([f"own {t}.", "often said.", f"cut {t}"])) for t in range(700)]  # a long one
    out += [(501, 5, "user", "the same row.")] * 90 + [(502, None, "user", "Hi.")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)


def result(df):
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_reports(spark, rows):
    assert result(repair.reports(frame(spark, rows))) == reports_by_hand(rows)


def test_damage(spark, rows):
    df = repair.damaged(frame(spark, rows))
    got = result(repair.reports(df, F.col("copies")))
    assert got == reports_by_hand(rows, damage=True)
    assert any(r[7] == "" for r in got) and len(got) == len({c for c, *_ in rows})


def test_ranges_do_not_matter(spark, rows):
    df = frame(spark, rows)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert result(repair.reports(df)) == reports_by_hand(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_repaired_turns(spark, rows):
    found = {}
    for r in sorted(repair.repaired_turns(frame(spark, rows)).collect(), key=lambda r: (str(r.conv_id), r.position)):
        assert r.position == len(found.setdefault(r.conv_id, []))
        found[r.conv_id].append(r)
    for c, *_, audit, sha in reports_by_hand(rows):
        own = found.get(c, [])
        assert good("".join(r.role[:1] for r in own)) and "".join(r.edit for r in own) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in own).encode()).hexdigest() == sha


def test_empty(spark, rows):
    none = frame(spark, rows[:1]).limit(0)
    assert repair.reports(none).count() == 0 and repair.repaired_turns(none).count() == 0


def test_cells_equal_all_edits():
    """Every audit of up to three turns and four insertions, tried one by one."""
    units = [(i, g, t) for i in ("s", "u", "a", "") for g, t in ((False, False), (True, False), (False, True))]
    rng = random.Random(2)
    cases = [()] + [(u,) for u in units] + [tuple(rng.choices(units, k=k)) for k in (2, 2, 3, 3, 3) for _ in range(12)]
    parser = repair.Parser()
    for turns in cases:
        best = None
        for edits in product("DKR", repeat=len(turns)):
            if any(e != "D" and turns[i][1] for i, e in enumerate(edits)):
                continue
            cost = sum({"D": 3, "K": 0, "R": 2}[e] + (e != "D" and turns[i][2]) for i, e in enumerate(edits))
            for inserts in product(range(4), repeat=len(turns) + 1):
                if sum(inserts) > 4:
                    continue
                audit = "".join("I" * n + e for n, e in zip(inserts, [*edits, ""], strict=True))
                spoken = [("I", None)] * inserts[0]
                for i, e in enumerate(edits):
                    if e != "D":
                        spoken.append((e, turns[i][0]))
                    spoken += [("I", None)] * inserts[i + 1]
                n = len(spoken)
                shapes = [""] if n == 0 else [s + "ua" * (m // 2) for s, m in (("", n), ("s", n - 1)) if m > 0 and m % 2 == 0]
                for shape in shapes:
                    if all(c == shape[i] if e == "K" else shape[i] in "ua" for i, (e, c) in enumerate(spoken)):
                        new = (cost + 2 * sum(inserts), audit)
                        best = new if best is None else min(best, new)
        assert repair.cheapest(parser.span(list(turns))) == best, turns


def test_every_split_gives_the_same_cell():
    rng = random.Random(9)
    units = [(i, g, t) for i in ("s", "u", "a", "") for g, t in ((False, False), (True, False), (False, True))]
    for _ in range(20):
        turns = rng.choices(units, k=9)
        cells = [repair.terminal(*t) for t in turns]
        spans = {(i, i + 1): cells[i] for i in range(9)}
        for length in range(2, 10):
            for i in range(10 - length):
                found = {repair.joined(spans[i, k], spans[k, i + length]) for k in range(i + 1, i + length)}
                assert len(found) == 1
                spans[i, i + length] = found.pop()
        assert repair.Parser().span(turns) == spans[0, 9]
