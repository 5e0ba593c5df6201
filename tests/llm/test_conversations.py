"""Conversation repair against a plain dynamic program over (cost, letters)."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from fitmill.llm import conversations as cv
from fitmill.llm import workload
from tests.llm.data import CLASHING, SMALL

NEXT = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")


def best(kinds):
    """Least cost, then least letters, by states after each row; insertions are tried up to three in a row."""
    def inserted(states):
        for _ in range(3):
            for q, (cost, letters) in list(states.items()):
                for r in set(NEXT[q]) & {"u", "a"}:
                    new = (cost + 5, letters + "I")
                    if r not in states or new < states[r]:
                        states[r] = new
        return states

    states = inserted({"": (0, "")})
    for kind in kinds:
        more, out = (5 if kind.isupper() else 0), {}
        for q, (cost, letters) in states.items():
            ways = [(q, cost + 2, "D")]
            if kind != "-":
                ways += [(kind.lower(), cost + more, "K")] if kind.lower() in NEXT[q] else []
                ways += [(r, cost + more + 1, "R") for r in set(NEXT[q]) & {"u", "a"}]
            for r, c, letter in ways:
                out[r] = min(out.get(r, (1 << 60, "")), (c, letters + letter))
        states = inserted(out)
    return min(states[q] for q in ("", "a") if q in states)


def plain(rows):
    kept, ids = defaultdict(list), {r[0] for r in rows}
    for conv_id, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            kept[conv_id] += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c in ids:
        some, seen, faults, kinds = sorted(kept[c], key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode())), set(), [], ""
        for _, _, role, text in some:
            final = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not final else "duplicate" if (role, text) in seen else "truncated" if final[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            kind = role[:1] if role[:1] in "sua" and role else "x"
            kinds += "-" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
        cost, audit = best(kinds)
        lines, k, q = [], 0, ""
        for letter in audit:
            if letter == "I":
                q = "a" if q == "u" else "u"
                lines.append({"u": "user", "a": "assistant"}[q] + ":")
                continue
            _, _, role, text = some[k]
            k += 1
            if letter != "D":
                q = role[:1] if letter == "K" else "a" if q == "u" else "u"
                lines.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[q]}:{text}")
        turns = {t for dated, t, _, _ in some if dated}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(x[2][:1] + y[2][:1] not in ("su", "ua", "au") for x, y in zip(some, some[1:]))
        out[c] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def run(given):
    return got(cv.digests(given, cv.repaired(cv.damaged(given))))


def test_cheapest_repairs_of_short_conversations():
    for n in range(5):
        for kinds in itertools.product("suaxSUAX-", repeat=n):
            assert cv.repair("".join(kinds)) == best("".join(kinds))
    draw = random.Random(3)
    for _ in range(200):
        kinds = "".join(draw.choice("suaxSUA-ua") for _ in range(draw.randrange(5, 40)))
        assert cv.repair(kinds) == best(kinds)


@pytest.mark.parametrize("sf", [SMALL, SMALL.replace("0.001", "0.01")])
def test_given_conversations(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(workload.op12_conversation_repair(spark, sf)) == plain(rows)


def test_awkward_and_long_conversations(spark):
    draw, roles = random.Random(1), ["system", "user", "assistant", "tool", "", None, "umpire"]
    texts = ["Yes.", "No!", "why", "", None, " \n", "the end.  \n", "x. ", "long " * 2000 + ".", "漢字。", "a?"]
    rows = [(c, draw.choice([None, *range(9)]), draw.choice(roles), draw.choice(texts)) for c in [1, 2, 3, None] for _ in range(12)]
    rows += [(7, k // 2 * 3, draw.choice(roles), f"{draw.choice(texts)} {k % 400}{draw.choice('.!?,')}") for k in range(3000)]
    rows += [(8, 5, "user", "Same.")] * 700  # one row many times, in one turn
    rows += [(9, k, "user", "Same.") for k in range(700)] + rows[:3] + [(10, None, None, None)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in CLASHING + ["fault", "first", "said", "part"]:
        given = given.selectExpr("*", f"'other' AS `{name}`")
    assert run(given) == plain(rows)
    assert run(given.limit(0)) == {}
