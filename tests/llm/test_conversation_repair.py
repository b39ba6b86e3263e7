"""Conversation repair against full interval charts and brute force over states."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from isohyet.llm import conversation_repair as repair
from isohyet.llm import queries
from isohyet.llm import repair_grammar as grammar
from tests.llm.common import SF, needs_tables

SPACE = " \t\n\x0b\x0c\r"
WHOLE = re.compile(r"(s?(ua)+)?")


def damage(rows):
    """The contract's damage, row by row: {conv: rows in order}."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        mine += [(turn, role, text)] * (2 if kind == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def plain_repair(rows):
    """The contract's numbers of one conversation by shortest paths over states, a row at a time."""
    seen, faults, letters = set(), [], []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "none"
        seen.add((role, text))
        faults.append(fault)
        letters.append(role[:1])
    steps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def insertions(best):
        for _ in range(4):
            for (p, x), q in steps.items():
                if p in best and x != "s":
                    c = (best[p][0] + 2, best[p][1] + "I", best[p][2] + (("user" if x == "u" else "assistant") + ":",))
                    best[q] = min(best.get(q, c), c)
        return best

    best = insertions({0: (0, "", ())})
    for (_, role, text), fault, initial in zip(rows, faults, letters):
        new = {}
        for p, (cost, audit, kept) in best.items():
            options = [(p, cost + 3, audit + "D", kept)]
            if fault not in ("blank", "duplicate"):
                extra = cost + (fault == "truncated")
                for (s, x), q in steps.items():
                    if s == p and x == initial:
                        options.append((q, extra, audit + "K", kept + (f"{role}:{text}",)))
                    if s == p and x != "s":
                        options.append((q, extra + 2, audit + "R", kept + (("user" if x == "u" else "assistant") + f":{text}",)))
            for q, *value in options:
                new[q] = min(new.get(q, tuple(value)), tuple(value))
        best = insertions(new)
    cost, audit, kept = min(best[q] for q in (0, 3) if q in best)
    turns = [t for t, _, _ in rows if t is not None]
    count = {f: faults.count(f) for f in grammar.FAULTS}
    return (max(turns) - min(turns) + 1 - len({*turns}) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:])), cost, audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest())


def answers(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def expected(rows):
    return {conv: plain_repair(mine) for conv, mine in damage(rows).items()}


def make(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_cells_equal_full_charts():
    """One cut per interval gives the same cells as all cuts, and as all edit sequences of short words."""
    rnd = random.Random(5)
    parser = grammar.Parser(remembered=20, short=4)
    for _ in range(40):
        word = "".join(rnd.choice(grammar.LETTERS) for _ in range(rnd.randrange(1, 13)))
        chart = {(i, i + 1): grammar.TERMINALS[c] for i, c in enumerate(word)}
        for length in range(2, len(word) + 1):
            for i in range(len(word) - length + 1):
                cells = [grammar.combined(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
                assert all(c == cells[0] for c in cells)
                chart[i, i + length] = cells[0]
        assert parser.cell(word) == chart[0, len(word)]


def test_best_repair_of_short_words_is_the_cheapest_of_all():
    for word in random.Random(4).sample(list(itertools.product("AEIMFGD", repeat=3)), 40):
        options = []
        for edits in itertools.product("KRD", repeat=3):
            for gaps in itertools.product(range(3), repeat=4):
                outcomes = [("", 0, "")]
                for i in range(4):
                    for _ in range(gaps[i]):
                        outcomes = [(s + x, c + 2, a + "I") for s, c, a in outcomes for x in "ua"]
                    if i == 3:
                        break
                    initial, fault = grammar.initial_of(word[i]), grammar.fault_of(word[i])
                    if edits[i] == "D":
                        outcomes = [(s, c + 3, a + "D") for s, c, a in outcomes]
                    elif fault in ("blank", "duplicate"):
                        outcomes = []
                    else:
                        extra = fault == "truncated"
                        outcomes = [(s + x, c + extra + 2 * (edits[i] == "R"), a + edits[i]) for s, c, a in outcomes
                                    for x in ("ua" if edits[i] == "R" else initial)]
                options += [(c, a) for s, c, a in outcomes if WHOLE.fullmatch(s)]
        assert grammar.best(grammar.Parser().cell("".join(word))) == min(options)


def test_random_conversations(spark):
    rnd = random.Random(1)
    texts = ["Yes.", "No!", "cut off", "", " ", " ", None, "Yes. ", "end?\n", "x" * 5000 + "."]
    rows = [(conv, rnd.choice([None, *range(12), 700, 900]) if conv % 3 else t, rnd.choice(["user", "assistant", "system", "tool", None, "", "ua"]),
             rnd.choice(texts) if conv % 2 else f"t{rnd.randrange(6)}.")
            for conv in range(60) for t in range(rnd.randrange(1, 9))]
    rows += [(None, 1, "user", "Null id."), (None, None, "assistant", "Null turn."), (7, 3, "user", "Same."), (7, 3, "user", "Same.")]
    got = answers(repair.audits(repair.damaged(make(spark, rows))))
    assert got == expected(rows)


def test_long_conversations(spark):
    """Several chunks of turns, one turn with very many rows, very long texts, and one text in every turn."""
    rnd = random.Random(2)
    rows = [(1, t, rnd.choice(["user", "assistant"]), f"Turn {t}." if t % 7 else "cut") for t in range(-300, 900)]
    rows += [(2, 5, rnd.choice(["user", "assistant", "system"]), f"n{i}.") for i in range(700)]
    rows += [(3, t, "user", "Over and over.") for t in range(600)] + [(4, 0, "user", "long " * 100_000), (4, 1, "assistant", "Fine.")]
    assert answers(repair.audits(repair.damaged(make(spark, rows)))) == expected(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Well."), (1, 2, "user", "?"), (1, 3, "user", " "), (2, 0, "system", "Be kind.")]
    got = [(r["conv_id"], r["position"], r["role"], r["text"]) for r in repair.repaired(repair.standard_rows(make(spark, rows))).orderBy("conv_id", "position").collect()]
    roles = "".join(r[2][0] for r in got if r[0] == 1)
    assert WHOLE.fullmatch(roles) and roles
    assert [t for c, _, _, t in got if c == 1 and t] == ["Hi.", "Well.", "?"]
    assert [r for r in got if r[0] == 2] in ([], [(2, 0, "system", "Be kind."), (2, 1, "user", ""), (2, 2, "assistant", "")])


def test_no_rows_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    none = make(spark, [])
    assert answers(repair.audits(repair.damaged(none))) == {}
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(30) for t in range(3)]
    clash = make(spark, rows).withColumns({n: F.lit("x") for n in ("chunk", "kind", "digest", "copies", "edits", "cost", "audit", "_kind", "_turn", "letter")})
    assert answers(repair.audits(repair.damaged(clash))) == expected(rows)
    dropped = next(c for c in range(9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert answers(repair.audits(repair.damaged(make(spark, [(dropped, 0, "user", "Gone.")])))) == {
        dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@needs_tables
def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert answers(queries.QUERIES["op12_conversation_repair"](spark, SF)) == expected(rows)


def test_pieces():
    assert repair.pieces_of("IKDIRKI", [1, 0, 2, 1]) == ["IK", "", "DIR", "KI"]
    with pytest.raises(IndexError):
        repair.pieces_of("K", [2])
