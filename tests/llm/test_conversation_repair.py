"""Conversation repair against brute force, and its defined cases."""

import hashlib
import heapq
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        row = (conv, turn, "user" if code == 4 else role, text)
        out += [row, row] if code == 3 else [row]
    return out


def faults(rows):
    """'blank', 'duplicate', 'truncated' or '' of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        found = BLANK.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "" if found[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Cheapest edits, least in ASCII among them, by a search over whole edit strings (Dijkstra by cost, then string)."""
    limit = 3 * len(rows) + 1
    queue, done = [(0, "", 0, "")], set()
    best = None
    while queue:
        cost, edits, at, roles = heapq.heappop(queue)
        if best is not None and cost > best[0]:
            break
        if (cost, edits) in done:
            continue
        done.add((cost, edits))
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best or (cost, edits), (cost, edits))
        ahead = lambda r: re.fullmatch("s?(ua)*u?", r)
        for role in "ua":
            if cost + 2 <= limit and ahead(roles + role):
                heapq.heappush(queue, (cost + 2, edits + "I", at, roles + role))
        if at < len(rows):
            heapq.heappush(queue, (cost + 3, edits + "D", at + 1, roles))
            if fault[at] in ("", "truncated"):
                extra = fault[at] == "truncated"
                if rows[at][0][:1] and ahead(roles + rows[at][0][:1]):
                    heapq.heappush(queue, (cost + extra, edits + "K", at + 1, roles + rows[at][0][:1]))
                for role in "ua":
                    if ahead(roles + role):
                        heapq.heappush(queue, (cost + extra + 2, edits + "R", at + 1, roles + role))
    return best


def repaired(rows, audit):
    lines, roles, k = [], "", 0
    for edit in audit:
        expected = "assistant" if roles[-1:] == "u" else "user"
        if edit == "I":
            lines.append(f"{expected}:")
            roles += expected[0]
            continue
        role, text = rows[k]
        k += 1
        if edit != "D":
            role = expected if edit == "R" else role
            lines.append(f"{role}:{text}")
            roles += role[0]
    assert k == len(rows) and re.fullmatch("(s?(ua)+)?", roles)
    return "\n".join(lines)


def brute(rows):
    groups = {conv: [] for conv, *_ in rows}
    for row in damaged(rows):
        groups[row[0]].append(row)
    out = {}
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        said = [r[2:] for r in held]
        fault = faults(said)
        turns = [r[1] for r in held if r[1] is not None]
        initials = [r[:1] for r, _ in said]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(said, fault)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256(repaired(said, audit).encode()).hexdigest()
        out[conv] = (gaps, *[fault.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)
    return out


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as signature", "'x' as seq", "1 as block", "'x' as audit", "'x' as code")
    found = cr.repair(df).collect()
    assert len(found) == len({r.conv_id for r in found})
    return {r[0]: tuple(r[1:]) for r in found}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([chr(65 + k) for k in range(16)]), max_size=6))
def test_layers_equal_search(symbols):
    rows, fault = [], []
    for s in symbols:
        kind, f = divmod(ord(s) - 65, 4)
        rows.append(("suaz"[kind], "x"))
        fault.append(["", "truncated", "blank", "duplicate"][f])
    *_, cost, audit = cr.Trie().answer("".join(symbols))
    assert (cost, audit) == cheapest(rows, fault)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="AEFIJMC", max_size=9), max_size=12))
def test_trie_shares_prefixes(found):
    trie = cr.Trie()
    assert [trie.answer(s) for s in sorted(found)] == [cr.Trie().answer(s) for s in sorted(found)]
    # each trie node is computed once
    assert trie.computed == len({s[: k + 1] for s in found for k in range(len(s))})


def test_repair_equals_brute_force(spark):
    say = ["Yes.", "No", "Well! ", "", " \t\n", "Why?", "Hm"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", ""]
    rows = []
    for conv in range(120):
        for turn in range(conv % 8):
            x = zlib.crc32(f"{conv}/{turn}".encode())
            role = ["user", "assistant"][turn % 2] if x % 3 else roles[x // 3 % 7]
            rows.append((conv, turn + (x % 11 == 0), role, say[x // 21 % 7]))
    rows += [(None, None, None, None), (None, 1, "user", "Hi."), (500, None, "user", "a."), (500, None, "assistant", "b."), (500, 3, None, "c."), (501, 1, "user", None), (502, 2, "user", "x."), (502, 2, "user", "x."), (502, 2, "assistant", "y."), (502, 7, "user", "x.")]
    want = brute(rows)
    assert got(spark, rows) == want
    assert any("I" in w[6] for w in want.values()) and any("R" in w[6] for w in want.values()) and any(w[0] for w in want.values())


def test_conversations_without_rows_and_long_ones(spark):
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = got(spark, [(dropped, 0, "user", "Hi."), *[(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(3000)]])
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    rows = sorted(damaged([(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(3000)]), key=lambda r: r[1:])
    said = [r[2:] for r in rows]
    assert found[1][:4] == (3000 - len({r[1] for r in rows}), *[faults(said).count(f) for f in ("blank", "duplicate", "truncated")])
    assert found[1][7] == hashlib.sha256(repaired(said, found[1][6]).encode()).hexdigest()


def test_ranges_do_not_matter(spark):
    rows = spark.createDataFrame([(c, t, "user" if t % 2 else "assistant", f"{t % 5}.") for c in range(3) for t in range(200)], SCHEMA)
    one, many = ({tuple(r) for r in cr.signatures(rows, n).collect()} for n in (1, 13))
    assert one == many


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)]])
def test_empty_and_null_tables(spark, rows):
    assert got(spark, rows) == brute(rows)


def test_query_equals_brute_force(spark):
    from quarryline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op11_conversation_repair"](spark, folder).collect()} == brute(rows)
