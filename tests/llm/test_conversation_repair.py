"""Conversation repair against a shortest-path search and, for small ones, all edits."""

import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from fleetlake.llm import conversation_repair as cr

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, cost long, kind string, rank long"


# -- plain versions ------------------------------------------------------------------


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def ident(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif bare[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("fine")
        seen.add((role, text))
    return out


def follow(state, role):
    """The state after a role initial, of ``(s?(ua)+)?``."""
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, role))


def plain_repair(rows, faults):
    """Cheapest edits with the ASCII-least audit: Dijkstra over (cost, audit) and places."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, out = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, audit, out
        for r, name in (("u", "user"), ("a", "assistant")):
            if follow(state, r):
                heapq.heappush(heap, (cost + 5, audit + "I", at, follow(state, r), out + ((name, ""),)))
        if at == len(rows):
            continue
        _, role, text = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, out))
        if faults[at] in ("blank", "duplicate"):
            continue
        extra = 5 if faults[at] == "truncated" else 0
        if role and follow(state, role[0]):
            heapq.heappush(heap, (cost + extra, audit + "K", at + 1, follow(state, role[0]), out + ((role, text),)))
        for r, name in (("u", "user"), ("a", "assistant")):
            if follow(state, r):
                heapq.heappush(heap, (cost + 1 + extra, audit + "R", at + 1, follow(state, r), out + ((name, text),)))


def all_edits(rows, faults, inserts=2):
    """The same by trying every edit of every row and up to ``inserts`` inserts at each place."""
    best = None
    choices = [["D"] if f in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for f in faults]
    for edits in itertools.product(*choices):
        for placed in itertools.product(*[["", *"ua", "ua", "au"][:1 + 2 * inserts]] * (len(rows) + 1)):
            cost, audit, initials, out = 0, "", "", []
            for i in range(len(rows) + 1):
                for r in placed[i]:
                    cost, audit, initials = cost + 5, audit + "I", initials + r
                    out.append(({"u": "user", "a": "assistant"}[r], ""))
                if i < len(rows):
                    audit += edits[i][0]
                    if edits[i] == "D":
                        cost += 2
                        continue
                    role = rows[i][1] if edits[i] == "K" else {"u": "user", "a": "assistant"}[edits[i][1]]
                    cost += (edits[i] != "K") + (5 if faults[i] == "truncated" else 0)
                    initials += role[:1] or "-"
                    out.append((role, rows[i][2]))
            body = initials[1:] if initials[:1] == "s" else initials
            if (body == "ua" * (len(body) // 2) and (body or not initials)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, tuple(out)
    return best


def plain(rows, every):
    groups = {}
    for conv, *rest in rows:
        groups.setdefault(conv, []).append(tuple(rest))
    found = []
    for conv in every:
        turns = sorted(groups.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], ident(*r[1:])))
        faults = faults_of(turns)
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = plain_repair(turns, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest))
    return sorted(found, key=lambda r: (r[0] is None, r[0] or 0))


def random_rows(rng, n_convs, longest=9):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User", "agent", "unknown"]
    texts = ["Yes.", "No!", "why", "Really?  \n", "", " \t", None, "Well...", "cut off", "long " * 50 + "."]
    rows = []
    for conv in range(n_convs):
        plain_one = rng.random() < 0.5
        for turn in range(rng.randint(1, longest)):
            role = ["user", "assistant"][turn % 2] if plain_one else rng.choice(roles)
            text = f"Text {conv} {turn}." if plain_one and rng.random() < 0.8 else rng.choice(texts)
            rows.append((conv if conv else None, rng.choice([turn, turn, turn + rng.randint(0, 3), None]), role, text))
    return rows


def as_rows(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def run(spark, rows, every=None):
    frame = as_rows(spark, rows)
    found = cr.repair_conversations(frame, None if every is None else spark.createDataFrame([(c,) for c in every], "conv_id long"))
    return sorted(map(tuple, found.collect()), key=lambda r: (r[0] is None, r[0] or 0))


# -- the algebra ---------------------------------------------------------------------


def symbol(role, fault):
    fault = {"fine": 0, "truncated": 1, "blank": 2, "duplicate": 3}[fault]
    return chr(ord("A") + 4 * ("sua".index(role[0]) if role[:1] in ("s", "u", "a") else 3) + fault)


def test_search_equals_all_edits():
    rng = random.Random(1)
    for _ in range(150):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool", ""]), "x") for i in range(rng.randint(0, 3))]
        faults = [rng.choice(["fine", "fine", "truncated", "blank"]) for _ in rows]
        assert plain_repair(rows, faults) == all_edits(rows, faults)


@pytest.mark.parametrize("seed", range(4))
def test_matrices_equal_search(seed):
    """Any bracketing of the product, rules included."""
    rng = random.Random(seed)
    grammar = cr.Grammar([])
    for _ in range(150):
        rows = [(i, rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]), "x")
                for i in range(rng.randint(1, 14))]
        faults = [rng.choice(["fine"] * 4 + ["truncated", "blank", "duplicate"]) for _ in rows]
        string = "".join(symbol(r[1], f) for r, f in zip(rows, faults))
        want = plain_repair(rows, faults)[:2]
        assert cr.finished(grammar.matrix(string)) == want
        cut = rng.randint(0, len(string))
        assert cr.finished(cr.product(grammar.matrix(string[:cut]), grammar.matrix(string[cut:]))) == want


def test_re_pair(spark):
    """Packed strings expand to their own; frequent pairs are gone; matrices stay the same."""
    rng = random.Random(5)
    strings = sorted({"".join(rng.choice("EIEIEIAFJ") for _ in range(rng.randint(1, 30))) for _ in range(400)} | {"EI" * 200, "E" * 301})
    packed, rules = cr.re_pair(spark.createDataFrame([(s,) for s in strings], "seq string"))
    assert rules

    def expand(c):
        return c if ord(c) < 0x100 else "".join(expand(x) for x in rules[ord(c) - 0x100])

    rows = packed.collect()
    assert sorted(r["seq"] for r in rows) == strings
    assert all("".join(map(expand, r["packed"])) == r["seq"] for r in rows)
    assert sum(len(r["packed"]) for r in rows) < 0.6 * sum(map(len, strings))
    with_rules, without = cr.Grammar(rules), cr.Grammar([])
    for r in rows[:150]:
        assert cr.finished(with_rules.matrix(r["packed"])) == cr.finished(without.matrix(r["seq"]))


# -- the operator --------------------------------------------------------------------


def test_odd_conversations(spark):
    """Null ids, turns, roles and texts, blank and repeated rows, odd roles, extra columns."""
    rows = random_rows(random.Random(2), 250)
    # a turn's rows are ordered by role and hash: nulls count as one space
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert run(spark, rows) == plain(clean, {r[0] for r in rows})


@pytest.mark.parametrize("bits", [1, 2])
def test_conversations_in_chunks(spark, monkeypatch, bits):
    """A third of all rows in one conversation, cut into many chunks and levels of them."""
    monkeypatch.setattr(cr, "CHUNK_BITS", bits)
    monkeypatch.setattr(cr, "GROUP_BITS", 1)
    rng = random.Random(bits)
    rows = random_rows(rng, 60) + [
        (999, i, rng.choice(["user", "assistant"]), rng.choice(["Fine.", "cut", "", f"Row {i}."])) for i in range(200)]
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert run(spark, rows) == plain(clean, {r[0] for r in rows})


def test_empty_and_absent(spark):
    assert run(spark, []) == []
    assert run(spark, [], [3]) == [(3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_far_turns(spark):
    """Turns at both ends of the range: more gaps than a long holds are null, then 0 by the head's default."""
    found = run(spark, [(1, -2**63, "user", "A."), (1, 2**63 - 1, "assistant", "B.")])
    assert found[0][6:8] == (0, "KK")


def test_query(spark, tmp_path):
    from fleetlake.llm.queries import QUERIES

    rows = random_rows(random.Random(7), 400)
    as_rows(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    found = QUERIES["op12_conversation_repair"](spark, str(tmp_path))
    got = sorted(map(tuple, found.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == plain(plain_damage(rows), {r[0] for r in rows})


def test_damage(spark):
    rows = random_rows(random.Random(9), 120)
    key = lambda r: tuple((x is None, x) for x in r)
    got = sorted(map(tuple, cr.damaged(as_rows(spark, rows)).collect()), key=key)
    assert got == sorted(plain_damage(rows), key=key)
