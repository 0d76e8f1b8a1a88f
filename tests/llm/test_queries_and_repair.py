"""Conversation repair, ranked search and benchmark passages, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import duckdb
import numpy as np
import pytest

import check
from paytally.llm import best_positions, conversations, queries, wu_manber
from paytally.llm.terms import query_blocks, words

SF = "/root/testdata/sf0.001"


# --- conversation repair -------------------------------------------------------

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
AFTER = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def damage(rows):
    """Rows after damage, by conversation and in order."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        found[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for part in found.values():
        part.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:32].encode(),
                                 hashlib.sha256(r[2].encode()).digest()))
    return found


def expected(rows):
    kinds, seen = [], set()
    for _, role, text in rows:
        visible = VISIBLE.findall(text)
        kind = None
        if not visible:
            kind = "blank"
        elif (role, text) in seen:
            kind = "duplicate"
        elif visible[-1] not in ".!?":
            kind = "truncated"
        kinds.append(kind)
        seen.add((role, text))
    n = len(rows)

    @lru_cache(None)
    def best(i, state, inserted):
        """Least (cost, audit, lines) from row i on; at most two inserts stand before a row."""
        ways = []
        if i == n and state in (0, 3):
            ways.append((0, "", ()))

        def add(cost, letter, line, nxt):
            if nxt is not None:
                ways.append((cost + nxt[0], letter + nxt[1], line + nxt[2]))

        role_in = "assistant" if state == 2 else "user"
        to = AFTER[state][role_in[0]]
        if inserted < 3:
            add(2, "I", (f"{role_in}:",), best(i, to, inserted + 1))
        if i < n:
            _, role, text = rows[i]
            add(3, "D", (), best(i + 1, state, 0))
            if kinds[i] not in ("blank", "duplicate"):
                extra = kinds[i] == "truncated"
                add(2 + extra, "R", (f"{role_in}:{text}",), best(i + 1, to, 0))
                if role[:1] in AFTER[state]:
                    add(extra, "K", (f"{role}:{text}",), best(i + 1, AFTER[state][role[:1]], 0))
        return min(ways, key=lambda w: w[:2]) if ways else None

    cost, audit, lines = best(0, 0, 0)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = Counter(kinds)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, seg string, audit long"


def reported(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    found = conversations.report(conversations.damaged(frame)).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found}


def made_up(rng, conv, n):
    texts = ["Yes.", "No!", "well", "", None, " \n", "so. ", "é?", "a" * 40 + ".", "a" * 40 + "b"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    turns = [rng.choice([k, k, k, k + 3, None]) for k in range(n)]
    return [(conv, t, rng.choice(roles), rng.choice(texts)) for t in turns]


@pytest.mark.parametrize("batch", [10_000, 3])
def test_repair_equals_brute_force(spark, batch):
    rng = random.Random(batch)
    rows = [r for conv in range(250) for r in made_up(rng, conv, rng.randint(1, 14))]
    rows += made_up(rng, None, 20) + made_up(rng, -5, 150)
    rows += rng.sample(rows, 60)  # rows that repeat
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = reported(spark, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {conv: expected(part) for conv, part in damage(rows).items()}
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], (conv, damage(rows)[conv])


def test_repair_of_odd_conversations(spark):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Gone."), (None, None, None, None), (5, None, "user", "x" * 200_000)]
    got = reported(spark, rows)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    want = {conv: expected(part) for conv, part in damage(rows).items()}
    assert got == want
    assert reported(spark, []) == {}


def test_repair_over_the_table(spark):
    rows = duckdb.connect().execute(f"SELECT * FROM '{SF}/conversations.parquet'").fetchall()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_conversations(spark, SF).collect()}
    assert got == {conv: expected(part) for conv, part in damage(rows).items()}


def test_repaired_rows_are_whole_conversations(spark):
    rng = random.Random(4)
    rows = [r for conv in range(40) for r in made_up(rng, conv, 9)]
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    bad = conversations.damaged(frame)
    planned = conversations.plan(bad)
    lines = defaultdict(list)
    for r in conversations.repaired(bad, planned).collect():
        lines[r.conv_id].append((r.place, r.role))
    for part in lines.values():
        assert [p for p, _ in sorted(part)] == list(range(len(part)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for _, role in sorted(part)))


def test_ranks_find_the_least_audit():
    rng = random.Random(1)
    for _ in range(200):
        steps = [(rng.randint(-1, 7), 1) for _ in range(rng.randint(0, 9))]
        steps = [(k, rng.randint(1, 3) if k == -1 else 1) for k, _ in steps]
        behind = rng.choice([conversations.AT_END, (3, 0, 1, 5), (conversations.NEVER, 2, 2, 2)])

        @lru_cache(None)
        def best(i, state, inserted, steps=tuple(steps), behind=behind):
            if i == len(steps):
                return (behind[state], "")
            kind, n = steps[i]
            to, ways = conversations.INSERTED[state], []

            def add(cost, letters, nxt):
                ways.append((cost + nxt[0], letters + nxt[1]))

            if inserted < 3:
                add(2, "I", best(i, to, inserted + 1))
            add(3 * n, "D" * n, best(i + 1, state, 0))
            if kind >= 0:
                add(2 + (kind & 1), "R", best(i + 1, to, 0))
                if conversations.KEPT[kind >> 1][state] >= 0:
                    add(kind & 1, "K", best(i + 1, conversations.KEPT[kind >> 1][state], 0))
            return min(ways)

        paths = conversations.Paths([(steps, behind), ([(2, 1)], behind)])
        for state in range(4):
            cost, audit = best(0, state, 0)
            found = paths.least(state)[0]
            if cost >= conversations.NEVER // 2:
                assert found is None
            else:
                assert (found[0], found[1] + behind[found[2]]) == (audit, cost)


# --- ranked search -------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k=50):
    split = [(i, Counter(terms(t))) for i, t in docs]
    split = [(i, c) for i, c in split if c]
    n_docs, n_words = len(split), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item].update(terms(text))
    found = []
    for item, held in asked.items():
        scores = []
        for i, c in split:
            m = 50 + 50 * sum(c.values()) * n_docs // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in held & c.keys()
            )
            if score > 0:
                scores.append((-score, i is not None, i or 0))
        scores.sort()
        found += [(item, r, i if there else None, -s) for r, (s, there, i) in enumerate(scores[:k], 1)]
    return sorted(found, key=repr)


def searched(spark, docs, items, **limits):
    frame = spark.createDataFrame([(*d, 1.0, 3) for d in docs], "doc_id long, text string, score double, n int")
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, rank string")
    found = best_positions.search(frame, asked, **limits)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"shard_postings": 40, "block_chars": 30}, {"k": 3}])
def test_search_equals_brute_force(spark, odd, limits):
    rng = random.Random(2)
    lexicon = ["the", "The", "of", "été", "x1", "b-c", *(f"w{k}" for k in range(30))]
    weights = [1 / (k + 1) for k in range(len(lexicon))]
    docs = [(k, " ".join(rng.choices(lexicon, weights, k=rng.randint(1, 40)))) for k in range(300)]
    docs += odd + docs[:20] + [(None, "w3 w4"), (400, "-- ?!")]
    items = [(k, " ".join(rng.choices(lexicon, k=rng.randint(1, 12)))) for k in range(12)]
    items += [(3, "w1 w29"), (None, "été w7"), (50, None), (51, "nothing like this"), (52, "same word")]
    assert searched(spark, docs, items, **limits) == ranked(docs, items, limits.get("k", 50))


def test_search_of_empty_tables(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, ""), (2, None)], [(1, "a")]) == []


def test_search_stops_early_and_counts_ties():
    """One term decides for five documents; all others are far behind."""
    n = 20_000
    impact = np.where(np.arange(n) < 5, 1000, 1)
    starts = np.arange(0, 2 * n + 1, 2)
    both = np.stack([impact, np.ones(n, np.int64)], axis=1).ravel()
    shard = best_positions.Shard(starts, np.tile([0, 1], n), both, 2)
    docs, scores, read = shard.best(np.array([0, 1]), 5)
    assert set(docs[scores == 1001]) == set(range(5))
    assert read < 200
    # Direct access moves the best position over places that were never read.
    assert not shard.seen.any() and not shard.scored.any() and not shard.wanted.any()
    _, scores, read = shard.best(np.array([0, 1]), 6)  # the sixth ties with all others
    assert len(scores) == n


# --- passages of test items ------------------------------------------------------


def passages(docs, items, length=10):
    windows = defaultdict(set)
    for item, text in items:
        split = terms(text)
        for k in range(len(split) - length + 1 if len(split) >= length else bool(split)):
            windows[tuple(split[k : k + length])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    found = []
    for doc, text in docs:
        split, hit, names = terms(text), set(), set()
        for size in sizes:
            for k in range(len(split) - size + 1):
                if names_here := windows.get(tuple(split[k : k + size])):
                    hit.update(range(k, k + size))
                    names |= names_here
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        found.append((doc, len(split), len(hit), len(names), digest, bool(hit)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("length, block_chars", [(10, 1 << 20), (4, 40), (1, 1 << 20)])
def test_passages_equal_brute_force(spark, odd, length, block_chars):
    rng = random.Random(length)
    lexicon = ["a", "B", "ç1", "dd", "e_f", "ß"]
    items = [(k, " ".join(rng.choices(lexicon, k=rng.randint(1, 16)))) for k in range(40)]
    items += items[:3] + [(None, "a a a"), (99, None), (98, "...")]
    docs = [(k, " ".join(rng.choices(lexicon, k=rng.randint(0, 120)))) for k in range(60)]
    docs += [(100 + k, f"x {rng.choice(items)[1]}, {rng.choice(items)[1]} y") for k in range(60)]
    docs += odd + docs[:5]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n_words int, items string")
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, spans string")
    found = wu_manber.overlaps(frame, asked, length, block_chars)
    for r in found.collect():
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:]))
    if block_chars == 1 << 20:
        got = sorted((tuple(r) for r in wu_manber.contamination(frame, asked, length).collect()), key=repr)
        assert got == passages(docs, items, length)
    else:
        got = Counter((r.doc_id, sum(s.end - s.begin for s in r.spans), len(r["items"])) for r in found.collect())
        assert got == Counter((d, hit, n) for d, _, hit, n, *_ in passages(docs, items, length))


def test_passages_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert wu_manber.contamination(docs.limit(0), items).collect() == []
    [row] = wu_manber.contamination(docs, items.limit(0)).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)


def test_search_skips_most_places():
    text = words(" ".join(f"w{k}" for k in range(1000)))
    looked_up = []

    class Noted(dict):
        def get(self, block, other=None):
            looked_up.append(block)
            return super().get(block, other)

    [table] = wu_manber.windows_of([words(" ".join(f"v{k}" for k in range(40)))], 10)
    table.table = Noted(table.table)
    assert list(table.search(text)) == []
    assert len(looked_up) <= 1000 / 8 + 1


def test_query_blocks_hold_every_row(spark):
    rows = [(k % 7, "x" * 20) for k in range(40)] + [(None, None), (None, "y")]
    frame = spark.createDataFrame(rows, "item_id long, text string")
    blocks = list(query_blocks(frame, most=100))
    assert Counter(tuple(r) for b in blocks for r in b) == Counter(rows)
    homes = defaultdict(set)
    for k, block in enumerate(blocks):
        for row in block:
            homes[row.item_id].add(k)
    assert len(blocks) > 1 and all(len(h) == 1 for h in homes.values())


@pytest.mark.parametrize("name", ["op12_best_positions", "op13_wu_manber"])
def test_query_equals_its_sql(spark, name):
    assert check.compare(spark, check.connect(SF), SF, name) == ""
