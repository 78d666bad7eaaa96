import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from widetab.llm import dialogue as D

from shared_fixtures import ready  # noqa: F401

SCHEMA = "conv_id bigint, turn bigint, role string, text string, c string, n long, audit int"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_search(kinds):
    """Brute force: all edit strings of up to three insertions more than needed."""
    best = None
    accept = re.compile(r"(s?(ua)+)?")
    for insertions in range(0, len(kinds) + 3):
        for places in itertools.combinations_with_replacement(range(len(kinds) + 1), insertions):
            for edits in itertools.product("KRD", repeat=len(kinds)):
                audit, cost, ok = "", 0, True
                for i in range(len(kinds) + 1):
                    k = places.count(i)
                    audit, cost = audit + "I" * k, cost + 5 * k
                    if i < len(kinds):
                        initial, must_go, truncated = kinds[i]
                        e = edits[i]
                        ok = ok and (e == "D" or not must_go)
                        audit += e
                        cost += {"K": 0, "R": 1, "D": 2}[e] + (5 if truncated and e != "D" else 0)
                if not ok or best is not None and (cost, audit) >= best:
                    continue
                # Roles: kept rows have theirs, others any of u and a.
                at = iter(kinds)
                letters = []
                for e in audit:
                    initial = next(at)[0] if e != "I" else ""
                    if e == "K":
                        letters.append([initial or "?"])
                    elif e != "D":
                        letters.append(["u", "a"])
                if any(accept.fullmatch("".join(p)) for p in itertools.product(*letters)):
                    best = (cost, audit)
    return best


def by_all_spans(cells):
    """CYK over every span and every place that splits it."""
    n = len(cells)
    held = {(i, i + 1): c for i, c in enumerate(cells)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            best = [None] * len(D.SYMBOLS)
            for j in range(i + 1, i + size):
                got = D.combine(held[i, j], held[j, i + size])
                best = [min((x for x in (a, b) if x is not None), default=None) for a, b in zip(best, got)]
            held[i, i + size] = best
    return held[0, n]


def test_cells_against_search():
    rng = random.Random(1)
    for _ in range(60):
        kinds = [(rng.choice(["s", "u", "a", ""]), rng.random() < .2, rng.random() < .3) for _ in range(rng.randint(1, 4))]
        kinds = [(c, g, t and not g) for c, g, t in kinds]
        assert D.cheapest(D.by_span_length([D.LEAVES[k] for k in kinds])) == by_search(kinds), kinds


def test_one_bracketing_gives_what_all_spans_give():
    rng = random.Random(2)
    for _ in range(40):
        cells = [D.LEAVES[rng.choice(["s", "u", "a", ""]), rng.random() < .2, rng.random() < .2] for _ in range(rng.randint(1, 14))]
        assert D.by_span_length(cells) == by_all_spans(cells)


def expected(rows):
    """SQL's rows for (conv_id, turn, role, text) tuples."""
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({D.REPAIR_SQL})").fetchall(), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, 1) for r in rows], SCHEMA)


def odd_rows():
    rng = random.Random(3)
    texts = ["", " \t", "Fine.", "cut off", "Fine. ", "ok!\n", None, "long " * 30000 + ".", "Zwölf Boxkämpfer 😀?"]
    roles = ["user", "assistant", "system", None, "", "tool", "user", "assistant"]
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts)) for _ in range(160)]
    rows += rows[:20] + [(7, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(60)]
    rows += [(c, 0, "user", "One.") for c in range(100, 160)]
    return rows


@pytest.mark.parametrize("segment,chars,parts", [(1024, 10**7, 4), (3, 10**7, 4), (2, 10**7, 9), (1024, 100, 40)])
def test_odd_rows_against_sql(spark, segment, chars, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    rows = odd_rows()
    got = D.repair(table(spark, rows), segment=segment, chars=chars).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_one_long_conversation(spark):
    rng = random.Random(4)
    rows = [(5, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"Turn {t}.", "Again.", "cut", ""]))
            for t in range(700)]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    got = D.repair(table(spark, rows), segment=16).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == expected(rows)
    assert len(got[0].audit) > 600


def test_empty_and_wholly_dropped(spark):
    assert D.repair(table(spark, [])).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = D.repair(table(spark, [(gone, 0, "user", "Hi.")])).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_text_ids(spark):
    rows = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "assistant", "Yes."), (None, 0, "user", "Hi.")],
                                 "conv_id string, turn int, role string, text string")
    assert sorted((str(r.conv_id), r.audit.count("D")) for r in D.repair(rows).collect())[0][0] in ("None", "a")
