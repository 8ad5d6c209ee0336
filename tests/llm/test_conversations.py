import hashlib
import random
import re
import zlib

import pytest

from caretrail.llm.conversations import END, after, collapsed, conversation_digest, power, repaired_conversations, repaired_turns, transition, unrolled

FOLDER = "/root/testdata/sf0.001"
CONVERSATIONS = "conv_id long, turn long, role string, text string, block int"
TURNS = "conv_id long, turn long, role string, text string, n long, edit string"
VALID = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows):
    """(cost, letters, lines) by trying every edit at every row, the last row first. rows: (role, text, fault)."""
    spell = {"u": "user", "a": "assistant"}

    def inserted(best):  # insert before what follows, up to three in a row
        for _ in range(3):
            best = {s: min([best[s], *[(c + 5, "I" + w, [f"{spell[r]}:", *ls]) for r, t in VALID[s].items() if r != "s" for c, w, ls in [best[t]]]]) for s in VALID}
        return best

    far = (10**9, "~", [])
    best = inserted({0: (0, "", []), 1: far, 2: far, 3: (0, "", [])})
    for role, text, fault in reversed(rows):
        here = {}
        for s in VALID:
            c, w, ls = best[s]
            ways = [(c + 2, "D" + w, ls)]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                for r, t in VALID[s].items():
                    c, w, ls = best[t]
                    if role[:1] == r:
                        ways.append((c + extra, "K" + w, [f"{role}:{text}", *ls]))
                    if r != "s":
                        ways.append((c + 1 + extra, "R" + w, [f"{spell[r]}:{text}", *ls]))
            here[s] = min(ways)
        best = inserted(here)
    return best[0]


def judged(rows):
    """The digest of one conversation; rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    cost, letters, lines = cheapest([(r, x, f) for (_, r, x), f in zip(rows, faults, strict=True)])
    initials = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    gap = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gap, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, letters, sha


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def brute(rows):
    """The query, row by row, from (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        own = out.setdefault(conv, [])
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm:
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            own += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return {(str(conv), *judged(in_order(own))) for conv, own in out.items()}


def digest(df):
    rows = df.collect()
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len(rows) == len({r.conv_id for r in rows})
    return {(str(r[0]), *r[1:]) for r in rows}


def odd_rows(rng, n, convs):
    texts = [None, "", " \t", "a.", "a", "b!", "c? \n", "d.e", "é.\x85", "f.", "g.", "h.", "i", "a.  "]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "u", "User"]
    return [(rng.choice(convs), rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts), 1) for _ in range(n)]


def test_runs_by_powers_cost_what_the_cheapest_edits_cost():
    rng = random.Random(1)
    kinds = [(r, f) for r in ("system", "user", "assistant", "x") for f in ("", "truncated")] + [("user", "blank")]
    for _ in range(400):
        chosen = [k for k in rng.choices(kinds, k=rng.randint(0, 6)) for _ in range(rng.choice([1, 1, 2, 5]))]
        symbols = [(8 if f == "blank" else "suax".index(r[0]) + 4 * (f != ""), 1) for r, f in chosen]
        runs = collapsed(symbols)
        expected = cheapest([(r, "t", f) for r, f in chosen])
        assert after(transition(runs), END)[0] == expected[0]
        letters = "".join(w * n for w, n, _ in unrolled(runs, END, 0))
        state = ([0] + [s for _, _, s in unrolled(runs, END, 0)])[-1]
        assert letters + "I" * (END[state] // 5) == expected[1]
    assert after(power(1, 10**12), END)[0] == 5 * 10**11  # every second one gets the other role


def test_query_equals_brute_force(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = [(*r, 1) for r in given] + odd_rows(random.Random(2), 900, [None, *range(10_000, 10_060)])
    rows += [(20_000 + i, t, "user", "x.", 1) for i in range(60) for t in (i,)]  # some of one row are left without any
    found = digest(conversation_digest(spark.createDataFrame(rows, CONVERSATIONS)))
    expected = brute(rows)
    assert found == expected and any(r[7] == "" for r in expected) and set("".join(r[7] for r in expected)) == set("DKR")  # an insert never pays at these costs
    assert conversation_digest(spark.createDataFrame([], CONVERSATIONS)).collect() == []


@pytest.mark.parametrize("block_rows", [1, 7])
def test_blocks_change_nothing(spark, block_rows):
    rows = [(c, t, r or " ", x or " ", 1, "e") for c, t, r, x, _ in odd_rows(random.Random(4), 700, [None, 1, 2, 3, 4, 5, 6, 7])]
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn, role, text))
    expected = {(str(c), *judged(in_order(own))) for c, own in by.items()}
    assert digest(repaired_conversations(spark.createDataFrame(rows, TURNS), block_rows)) == expected


def test_one_long_conversation_is_split(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["same.", f"text {t}.", f"cut {t}", ""]), 1, "e") for t in range(6000)]
    rows += [(1, 7000, "user", "often.", 10_000, "e"), (2, 0, "user", "x.", 0, "e")]
    own = [(t, r, x) for _, t, r, x, n, _ in rows[:-1] for _ in range(n)]
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    assert digest(repaired_conversations(df, 300)) == {("1", *judged(own)), ("2", *judged([]))}


def test_edits_spell_the_repaired_conversation(spark):
    rows = [(c, t, r, x, 1 + (i % 5 == 0), "e") for i, (c, t, r, x, _) in enumerate(odd_rows(random.Random(6), 300, [1, 2, 3]))]
    df = spark.createDataFrame(rows, TURNS)
    expected = {r.conv_id: r for r in repaired_conversations(df).collect()}
    edits = {}
    for e in sorted(repaired_turns(df, 20).collect(), key=lambda e: (e.block, e.seq)):
        edits.setdefault(e.conv_id, []).append(e)
    assert set(edits) == set(expected)
    for conv, own in edits.items():
        lines = "\n".join(f"{e.role}:{e.text}" for e in own if e.edit != "D")
        assert "".join(e.edit * e.times for e in own) == expected[conv].audit
        assert hashlib.sha256(lines.encode()).hexdigest() == expected[conv].repaired_sha256
        assert all((e.text is None) == (e.edit == "D") and (e.edit == "I") <= (e.turn is None) for e in own)
