import hashlib
import itertools
import random
import zlib

from furrow.llm import repair as R
from tests.conftest import rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        end = text.strip(" \t\n\v\f\r")
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(turns):
    """Cheapest, then ASCII-least, edits: all of them up to a bound on cost, walked as whole strings."""
    found = faults(turns)
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = None
    todo = [(0, "", 0, "", ())]  # cost, edits, rows done, last initial, lines
    limit = 4 * len(turns)
    while todo:
        cost, audit, k, last, lines = todo.pop()
        if cost > limit or (best and cost > best[0]):
            continue
        if k == len(turns) and last in ("", "a") and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, lines)
        for initial, name in (("u", "user"), ("a", "assistant")):
            if initial in legal[last] and audit[-2:] != "II":
                todo.append((cost + 3, audit + "I", k, initial, (*lines, name + ":")))
        if k < len(turns):
            role, text = turns[k]
            todo.append((cost + 4, audit + "D", k + 1, last, lines))
            if found[k] not in ("blank", "duplicate"):
                more = 3 if found[k] == "truncated" else 0
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if initial in legal[last]:
                        todo.append((cost + 3 + more, audit + "R", k + 1, initial, (*lines, f"{name}:{text}")))
                if role[:1] and role[:1] in legal[last]:
                    todo.append((cost + more, audit + "K", k + 1, role[:1], (*lines, f"{role}:{text}")))
    return best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest()


def test_cheapest_and_least_edits():
    kinds = [("user", "u{}."), ("assistant", "a{}."), ("system", "s{}."), ("user", "u{}"), ("assistant", " "), ("tool", "t{}."), ("user", "same.")]
    rng = random.Random(1)
    cases = [list(c) for n in range(4) for c in itertools.product(kinds, repeat=n)] + [rng.choices(kinds, k=rng.randint(4, 6)) for _ in range(150)]
    cases += [[("assistant", "a{}.")] * n for n in (5, 6, 7)] + [[("system", "s{}.")] * 5]
    for case in cases:
        turns = [(role, text.format(k)) for k, (role, text) in enumerate(case)]
        got = R.repaired(turns)
        assert (got["cost"], got["audit"], got["repaired_sha256"]) == brute(turns), turns


def test_survivors_coalesce():
    regular = [("user" if k % 2 == 0 else "assistant", f"t{k}.") for k in range(20_000)]
    got = R.repaired(regular)
    assert got["cost"] == 0 and got["audit"] == "K" * 20_000 and got["most_pending"] < 20
    rng = random.Random(2)
    mixed = [(rng.choice(["user", "assistant", "user", "assistant", "system"]), f"t{k}" + rng.choice(".. ")) for k in range(5_000)]
    got = R.repaired(mixed)
    assert got["most_pending"] < 200 and len(got["audit"]) >= 5_000
    # two phases tie for ever: nothing coalesces, and rows still take constant time
    tied = R.repaired([("assistant", f"t{k}.") for k in range(10_000)])
    assert tied["cost"] == 15_000


def test_as_brute_force(spark):
    rng = random.Random(3)
    data = []
    for c in [*range(40), None]:
        for t in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, ""])
            text = rng.choice(["Yes.", "No", None, "", "  ", "A b!\n", "Long " * 2_000 + "?", f"{c}-{t}."])
            data.append((c, rng.choice([t, t, t, None]), role, text, "x"))
    data += [data[0], (2**60 + 1, 2**60, "user", "Hi.", None), (2**60 + 1, 2**60 + 3, "assistant", "Ho.", None)]
    df = spark.createDataFrame(data, SCHEMA)
    got = {}
    for r in R.repair(R.damaged(df), df.select("conv_id")).collect():
        assert r["conv_id"] not in got
        got[r["conv_id"]] = r
    groups = {}
    for c, t, role, text, _ in data:
        own = groups.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        own += [(t is not None, t or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert set(got) == set(groups)
    for c, own in groups.items():
        own.sort(key=lambda r: (*r[:3], hashlib.md5(r[3].encode()).hexdigest()))
        turns = [r[2:] for r in own]
        found, ts = faults(turns), [r[1] for r in own if r[0]]
        initials = [r[0][:1] for r in turns]
        want = {"gaps": max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, **{f: found.count(f) for f in ("blank", "duplicate", "truncated")},
                "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))}
        want["cost"], want["audit"], want["repaired_sha256"] = brute(turns)
        assert {k: got[c][k] for k in COLUMNS} == want, turns


def test_none(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(R.repair(R.damaged(empty), empty.select("conv_id"))) == []
    lone = R.repair(empty, spark.createDataFrame([(7,)], "conv_id bigint")).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in lone] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
