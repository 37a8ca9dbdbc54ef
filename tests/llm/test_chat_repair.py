import hashlib
import itertools
import random
from collections import defaultdict
from zlib import crc32

from pyspark.sql import functions as F

from lumenfield.llm import chat_repair as R
from lumenfield.llm import queries
from tests.llm.data import written

SCHEMA = "conv_id long, turn long, role string, text string"


def legal(initials: str) -> bool:
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def slow_edits(codes):
    """All ways of at most one more edit than twice the turns and two, by cost and letters."""
    best = None
    frontier = [(0, "", 0, "")]
    limit = 3 * len(codes) + 4
    while frontier:
        following = []
        for cost, letters, i, made in frontier:
            if best is not None and cost > best[0]:
                continue
            if i == len(codes) and legal(made) and (best is None or (cost, letters) < best):
                best = (cost, letters)
            if cost > limit:
                continue
            for role in "ua":
                if len(letters) < 2 * len(codes) + 2 and prefix(made + role):
                    following.append((cost + 2, letters + "I", i, made + role))
            if i < len(codes):
                kind, fault = divmod(codes[i], 4)
                following.append((cost + 3, letters + "D", i + 1, made))
                if fault != R.REMOVED:
                    for role in "ua":
                        if prefix(made + role):
                            following.append((cost + 2 + fault, letters + "R", i + 1, made + role))
                    if kind < 3 and prefix(made + "sua"[kind]):
                        following.append((cost + fault, letters + "K", i + 1, made + "sua"[kind]))
        frontier = following
    return best


def prefix(made: str) -> bool:
    rest = made[1:] if made[:1] == "s" else made
    return ("ua" * len(rest)).startswith(rest)


def test_edits_against_all_ways():
    codes = [R.code_of(i, f) for i in ("s", "u", "a", "x") for f in (R.FINE, R.TRUNCATED, R.REMOVED)]
    assert R.cheapest_edits([]) == (0, "")
    for n in (1, 2):
        for some in itertools.product(codes, repeat=n):
            assert R.cheapest_edits(some) == slow_edits(some), some
    rng = random.Random(3)
    for _ in range(120):
        some = [rng.choice(codes) for _ in range(rng.randrange(3, 6))]
        assert R.cheapest_edits(some) == slow_edits(some), some


def plain_edits(codes):
    """The same recurrence with all vectors kept."""
    vectors = [R.END_VECTOR]
    for c in reversed(codes):
        vectors.append(R.before(c, vectors[-1]))
    vectors.reverse()
    return vectors[0][0]


def test_long_conversations_need_few_vectors():
    rng = random.Random(9)
    for n in (0, 1, 2, 3, 4, 99, 100, 101, 20000):
        codes = [R.code_of(rng.choice(["s", "u", "a", "", "t"]), rng.choice([0, 0, 0, 1, 2])) for _ in range(n)]
        cost, letters = R.cheapest_edits(codes)
        assert cost == plain_edits(codes)
        assert len(letters.replace("I", "")) == n


def brute(rows):
    """What the query has to give, from rows (conv_id, turn, role, text)."""
    space = lambda x: " " if x is None else str(x)
    out, convs = defaultdict(list), {r[0] for r in rows}
    for conv, turn, role, text in rows:
        role, text = space(role), space(text)
        k = crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else text.translate({ord(c): None for c in ".!?"}) if k == 2 else text
        role = "user" if k == 4 else role
        out[conv] += [(turn, role, text)] * (2 if k == 3 else 1)
    found = {}
    for conv in convs:
        mine = sorted(out[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        codes, seen, faults = [], set(), defaultdict(int)
        for turn, role, text in mine:
            left = text.rstrip("\x20\t\n\x0b\x0c\r")
            fault = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            codes.append(R.code_of(role[:1], R.REMOVED if fault in ("blank", "duplicate") else R.TRUNCATED if fault else R.FINE))
        turns = [t for t, *_ in mine if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = R.cheapest_edits(codes)
        said, made, rest = [], "", list(mine)
        for letter in audit:
            them = "assistant" if made[-1:] == "u" else "user"
            if letter == "I":
                said.append(f"{them}:")
            else:
                _, role, text = rest.pop(0)
                if letter == "D":
                    continue
                them = them if letter == "R" else role
                said.append(f"{them}:{text}")
            made += them[0]
        assert legal(made)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        found[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return found


def result(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"place": F.lit("x"), "kind": F.lit("x"), "audit": F.lit(1), "dropped": F.lit("x"), "tie": F.lit("x")})
    turns = R.damaged(written(df, parts))
    reports = R.report(turns, "dropped")
    out = R.repaired_digests(reports, R.repair(turns.filter("NOT dropped"), reports))
    return {r["conv_id"]: tuple(r[c] for c in (*R.COUNTS, "audit", "repaired_sha256")) for r in out.collect()}


def test_awkward_conversations(spark):
    rng = random.Random(1)
    texts = ["Yes.", "No", "", " \n", None, "What?! ", "Same.", "word " * 40000 + "end.", "é😀.", " "]
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "User"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for c in [None, *range(60)] for _ in range(rng.randrange(9))]
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(3000)]
    rows += [(1001, 5, "user", "Same.")] * 7
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == {}


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[c] for c in (*R.COUNTS, "audit", "repaired_sha256")) for r in queries.op13_chat_repair(spark, sf_dir).collect()}
    assert got == brute(rows)
