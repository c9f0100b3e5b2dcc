import hashlib
import itertools
import random
import re
import zlib

import pytest

from gleaner.llm import conversations as cv

PATTERN = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id bigint, turn bigint, role string, text string, codes string, head string, copies int, block int, gaps double"


def brute(codes):
    """Cheapest repair by trying all edits: every choice per row, then the cheapest inserts are tried in every place."""
    best = None
    options = []
    for code in codes:
        speaker, fault = divmod(ord(code) - cv.CODE_BASE, 4)
        speaker, fault = cv.SPEAKERS[speaker], cv.FAULTS[fault]
        more = fault == "t"
        choice = [("D", "", 3)]
        if fault in ".t":
            choice += [("K", speaker, more), ("R", "u", 2 + more), ("R", "a", 2 + more)]
        options.append(choice)
    for places in range(2 * len(codes) + 3):
        if best is not None and 2 * places > best[0]:
            break
        for where in itertools.combinations_with_replacement(range(len(codes) + 1), places):
            for kinds in itertools.product("ua", repeat=places):
                for rows in itertools.product(*options):
                    letters, roles, cost = [], [], 2 * places
                    for i in range(len(codes) + 1):
                        for w, kind in zip(where, kinds):
                            if w == i:
                                letters.append("I")
                                roles.append(kind)
                        if i < len(codes):
                            letters.append(rows[i][0])
                            roles.append(rows[i][1])
                            cost += rows[i][2]
                    if PATTERN.match("".join(roles)):
                        found = (cost, "".join(letters))
                        best = found if best is None else min(best, found)
    return best


def plain(codes):
    """The same by filling a table from the end, for longer conversations."""
    n = len(codes)
    after = {0: (0, ""), 3: (0, "")}
    for i in range(n, -1, -1):
        now = {}
        for q in range(4):
            found = []
            if i == n:
                if q in after:
                    found.append(after[q])
            else:
                speaker, fault = divmod(ord(codes[i]) - cv.CODE_BASE, 4)
                steps = [("D", 3, q)]
                if cv.FAULTS[fault] in ".t":
                    more = int(cv.FAULTS[fault] == "t")
                    if cv.SPEAKERS[speaker] == "s" and q == 0:
                        steps.append(("K", more, 1))
                    if cv.SPEAKERS[speaker] == "u" and q != 2:
                        steps.append(("K", more, 2))
                    if cv.SPEAKERS[speaker] == "a" and q == 2:
                        steps.append(("K", more, 3))
                    steps.append(("R", 2 + more, 3 if q == 2 else 2))
                found += [(c + following[to][0], letter + following[to][1]) for letter, c, to in steps if to in following]
            now[q] = min(found) if found else None
        for _ in range(3):  # inserts within a layer
            for q, to in ((0, 2), (1, 2), (2, 3), (3, 2)):
                if now[to] is not None:
                    new = (2 + now[to][0], "I" + now[to][1])
                    now[q] = new if now[q] is None else min(now[q], new)
        following = {q: v for q, v in now.items() if v is not None}
    return following[0]


def random_codes(rng, n):
    return "".join(cv.row_code(rng.choice("ssuuuaaax"), rng.choice("......bdtt")) for _ in range(n))


def test_small_repairs_against_all_edits():
    rng = random.Random(3)
    for n, times in ((0, 1), (1, 36), (2, 60), (3, 12)):
        for _ in range(times):
            codes = random_codes(rng, n)
            assert cv.cheapest_repair(codes) == brute(codes) == plain(codes), codes


def test_long_repairs_against_a_table():
    rng = random.Random(5)
    for n in [*range(4, 40), 63, 64, 65, 200, 1000]:
        codes = random_codes(rng, n)
        assert cv.cheapest_repair(codes) == plain(codes), codes


def test_prices_bound_distances_and_settled_ones_meet_them():
    codes = random_codes(random.Random(9), 30)
    auction = cv.Auction(codes)
    auction.solve()
    for node in range(auction.end):
        for _, cost, to in auction.arcs(node):
            assert auction.price[node] <= cost + auction.price[to]


def expected(rows):
    """Every conversation by plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        held = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0)):
            space = lambda v: " " if v is None else v
            kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
            role, text = space(role), space(text)
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            held += [(turn, role, text)] * (2 if kind == 3 else 1)
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, codes = set(), ""
        for _, role, text in held:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "."
            seen.add((role, text))
            codes += cv.row_code(role[:1] if role[:1] in ("s", "u", "a") else "x", fault)
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = "".join(r[1][:1] or "?" for r in held)
        illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(held) - 1))
        faults = "".join(cv.FAULTS[(ord(c) - cv.CODE_BASE) % 4] for c in codes)
        cost, audit = plain(codes) if codes else (0, "")
        lines, last, queue = [], "", list(held)
        for letter in audit:
            follow = "assistant" if last == "u" else "user"
            if letter == "I":
                lines.append(follow + ":")
            else:
                _, role, text = queue.pop(0)
                if letter == "D":
                    continue
                lines.append(f"{role if letter == 'K' else follow}:{text}")
            last = lines[-1][:1]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest)
    return out


def as_table(spark, rows):
    return spark.createDataFrame([(*r, "c", "h", 4, 5, 6.0) for r in rows], SCHEMA)


def messy_rows():
    rng = random.Random(11)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["Yes.", "No!", "Why?", "so it goes", "", " \t\x0b", "Tail. \n\n", None, "é 日本 🙂.", "The same."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "sys"]), text))
    rows += [(None, 0, "user", "Hello."), (None, 1, "assistant", "Hi."), (None, None, None, None)]
    rows += [(200, 7, "user", "Twice."), (200, 7, "user", "Twice."), (200, 7, "user", "Twice.")]
    rows += [(300, t, "user" if t % 2 else "assistant", f"Row {t}." if t % 7 else "cut") for t in range(9000)]
    lost = next(c for c in range(400, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(lost, 0, "user", "Gone."), (1001, 0, "user", "long " * 200_000 + ".")]


def test_conversations_against_plain_python(spark):
    rows = messy_rows()
    got = {r[0]: tuple(r)[1:] for r in cv.repair(as_table(spark, rows)).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for conv, row in want.items():
        assert got[conv] == row, conv


def test_no_rows(spark):
    assert cv.repair(as_table(spark, [])).collect() == []


@pytest.mark.parametrize("conv_id", ["a", None])
def test_text_ids(spark, conv_id):
    table = spark.createDataFrame([(conv_id, 1, "user", "Hi."), (conv_id, 2, "assistant", "Hello.")], "conv_id string, turn int, role string, text string")
    (row,) = cv.repair(table).collect()
    assert row["conv_id"] == conv_id and row["cost"] == 0 or row["audit"]
