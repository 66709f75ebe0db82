import hashlib
import itertools
import random

import pytest

from spoor.llm import repair

NEXT = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}


def cheapest(kinds: str) -> tuple[int, str]:
    """Cost and letters over all lists of edits, whole audits compared."""
    best = {"": (0, "")}

    def inserted(found):
        for _ in range(2):
            for state, (cost, told) in list(found.items()):
                for role in "ua":
                    after = NEXT[role].get(state)
                    way = (cost + 5, told + "I")
                    if after and (after not in found or way < found[after]):
                        found[after] = way
        return found

    for k in kinds:
        new: dict = {}

        def put(state, way):
            if state is not None and (state not in new or way < new[state]):
                new[state] = way

        for state, (cost, told) in inserted(dict(best)).items():
            put(state, (cost + 2, told + "D"))
            if k != "d":
                more = 5 if k.isupper() else 0
                put(NEXT.get(k.lower(), {}).get(state), (cost + more, told + "K"))
                for role in "ua":
                    put(NEXT[role].get(state), (cost + more + 1, told + "R"))
        best = new
    ends = inserted(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def solved(kinds: str) -> tuple[int, str]:
    cost, last, tail = repair.finish(repair.between(kinds, repair.EMPTY))
    return cost, "".join(repair.letters(kinds, repair.EMPTY, last)) + "I" * tail


def test_all_short_conversations():
    for n in range(1, 5):
        for kinds in itertools.product(repair.KINDS, repeat=n):
            assert solved("".join(kinds)) == cheapest("".join(kinds)), kinds


def test_long_conversations():
    rng = random.Random(3)
    for _ in range(200):
        kinds = "".join(rng.choices(repair.KINDS, k=rng.randrange(5, 90)))
        assert solved(kinds) == cheapest(kinds), kinds


def test_a_conversation_of_many_rows_is_solved_in_linear_space():
    kinds = "".join(random.Random(5).choices(repair.KINDS, k=20_000))
    assert solved(kinds) == cheapest(kinds)


def test_stretches_meet_like_rows():
    rng = random.Random(4)
    for _ in range(100):
        kinds = "".join(rng.choices(repair.KINDS, k=rng.randrange(2, 40)))
        cuts = sorted(rng.sample(range(1, len(kinds)), min(len(kinds) - 1, 4)))
        parts = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, len(kinds)])]
        tables = [tuple(repair.between(p, s) for s in range(4)) for p in parts]
        cost, last, tail = repair.finish(repair.between(tables, repair.EMPTY))
        states = repair.crossings(tables, repair.EMPTY, last)
        told = [x for p, a, b in zip(parts, states, states[1:]) for x in repair.letters(p, a, b)]
        assert (cost, "".join(told) + "I" * tail) == cheapest(kinds)


SPACE = " \t\n\x0b\x0c\r"


def plain(turns) -> dict:
    """What the operator returns, from (conv_id, turn, role, text) in plain Python."""
    convs: dict = {}
    for conv, turn, role, text in turns:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, kinds, counts = set(), "", [0, 0, 0]
        for turn, role, text in rows:
            bare = text.rstrip(SPACE)
            kind = role[:1] if role[:1] in ("s", "u", "a") and role else "o"
            if not bare:
                kind, at = "d", 0
            elif (role, text) in seen:
                kind, at = "d", 1
            elif bare[-1] not in ".!?":
                kind, at = kind.upper(), 2
            else:
                at = None
            if at is not None:
                counts[at] += 1
            seen.add((role, text))
            kinds += kind
        cost, audit = cheapest(kinds)
        lines, last, i = [], "", 0
        for letter in audit:
            if letter == "I":
                last = "assistant" if last[:1] == "u" else "user"
                lines.append(last + ":")
                continue
            _, role, text = rows[i]
            i += 1
            if letter == "D":
                continue
            last = role if letter == "K" else "assistant" if last[:1] == "u" else "user"
            lines.append(f"{last}:{text}")
        initials = [r[1][:1] for r in rows]
        numbers = [r[0] for r in rows if r[0] is not None]
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *counts,
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(turns_df, **options) -> dict:
    done = repair.repaired(turns_df, **options)
    told = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in repair.told(done.rows).collect()}
    return {r["conv_id"]: (*[r[f] for f in repair.FAULTS], *told[r["conv_id"]])
            for r in done.faults.collect()}


SCHEMA = "conv_id long, turn long, role string, text string, at long, kind string, digest string"


def frame(spark, turns):
    return spark.createDataFrame([(*t, 7, "x", "y") for t in turns], SCHEMA)


EDGES = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Hi!"),
    (2, 0, "system", "Be brief."), (2, None, "user", "null turn?"), (2, 3, None, "no role."),
    (2, 3, "assistant", None), (2, 4, "assistant", " \x0b\x0c "), (2, 9, "tool", "a tool."),
    (None, 0, "user", "no conversation"), (None, None, None, None), (None, 0, "user", "no conversation"),
    (3, None, "user", "?"), (3, None, "user", "?"), (3, None, "assistant", "same turn."),
    (4, 0, "", "empty role."), (4, 1, "sys", "odd."), (4, 2, "unknown", "odd too."), (4, 3, "assistant", ""),
    (5, 0, "assistant", "z" * 200_000), (5, 1, "user", "é 😀."), (5, 1, "user", "é 😀."),
    (6, 0, "user", "only me."), (7, 2, "system", "only rules."),
]


def test_edges(spark):
    assert found(frame(spark, EDGES)) == plain(EDGES)


def test_empty_table(spark):
    assert found(frame(spark, [])) == {}


def test_hot_conversation_over_many_stretches(spark, monkeypatch):
    rng = random.Random(11)
    turns = [(1 if i % 2 else rng.randrange(2, 9), rng.choice([None, *range(90)]),
              rng.choice(["system", "user", "assistant", "assistant", None, "tool"]),
              rng.choice([None, "", "same.", f"text {i}.", f"cut {i}"])) for i in range(500)]
    monkeypatch.setattr(repair, "STRETCH", 3)
    assert found(frame(spark, turns), fan=4) == plain(turns)


def test_damage_follows_the_checksum(spark):
    import zlib

    turns = [(c, t, "assistant", f"One. Two! {c}:{t}?") for c in (None, 1, 2, 3) for t in (None, *range(30))]
    want = []
    for c, t, role, text in turns:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate(str.maketrans("", "", ".!?")) if fault == 2 else text
        row = (c, t, "user" if fault == 4 else role, text)
        want += [row] * (2 if fault == 3 else 1)
    got = [tuple(r) for r in repair.damaged(frame(spark, turns)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("conv_type", ["string", "int"])
def test_other_id_types(spark, conv_type):
    turns = frame(spark, EDGES).selectExpr(f"cast(conv_id as {conv_type}) as c", "turn as t", "role as r", "text as x")
    got = found(turns, conv_col="c", turn_col="t", role_col="r", text_col="x")
    assert {None if k is None else int(k): v for k, v in got.items()} == plain(EDGES)
