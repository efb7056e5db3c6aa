"""Structure repair and the prefix trie of conversations against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import cache

from pyspark.sql import functions as F

from tallyline.llm import prefix_trie, queries, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, block string, place string"
SPACE = " \t\n\x0b\x0c\r"


def made_rows(seed: int, conversations: int, most: int, null_turns: bool = True):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        turn = rng.randint(-3, 3)
        for k in range(rng.randint(1, most)):
            role = rng.choice(["system"] if k == 0 else ["user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "one two", f"text {rng.random()}.", " ", "", None, "ünï ?", "a. \n"])
            rows.append((c if c else None, turn if rng.random() < 0.95 or not null_turns else None, role, text, "x", "y"))
            turn += rng.choice([1, 1, 1, 2, 0])
    return rows


def plain_damage(rows):
    out: dict = {}
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = out.setdefault(conv, [])
        text = "" if n == 1 else "".join(c for c in text if c not in ".!?") if n == 2 else text
        mine += [(turn, "user" if n == 4 else role, text)] * (0 if n == 0 else 2 if n == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash), by the cheapest suffix for every place and state."""
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    @cache
    def best(at, state, inserts=0):
        found = [(0, "", ())] if at == len(rows) and state in ("", "a") else []
        def go(cost, letter, line, then):
            found.append((cost + then[0], letter + then[1], ((line,) if line else ()) + then[2]))
        if inserts < 2:
            go(5, "I", names[state] + ":", best(at, names[state][0], inserts + 1))
        if at < len(rows):
            _, role, text = rows[at]
            go(2, "D", None, best(at + 1, state))
            if faults[at] in ("", "truncated"):
                more = 5 if faults[at] else 0
                if role[:1] in moves[state]:
                    go(more, "K", f"{role}:{text}", best(at + 1, moves[state][role[:1]]))
                go(1 + more, "R", f"{names[state]}:{text}", best(at + 1, names[state][0]))
        return min(found, default=(10**9, "", ()))
    cost, audit, lines = best(0, "")
    turns = {t for t, *_ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def as_written(spark, rows, tmp_path, schema=SCHEMA):
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def repaired(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_repair_equals_plain_search(spark, tmp_path):
    rows = made_rows(1, 300, 9) + [(900, None, None, None, "", ""), (901, 5, "user", "long " * 60_000 + ".", "", "")]
    as_written(spark, rows, tmp_path)
    got = repaired(queries.op11_conversation_repair(spark, str(tmp_path)))
    assert got == {c: plain_repair(r) for c, r in plain_damage(rows).items()}
    assert got[900][:6] in ((0, 1, 0, 0, 0, 2), (0, 0, 0, 0, 0, 0), (0, 2, 0, 0, 1, 4))


def test_giant_conversations_are_spilled_with_equal_results(spark, scratch, tmp_path):
    rows = made_rows(2, 25, 60) + [(77, 4, "user", "Same.", "", "")] * 40 + [(78, k, "user", "Same.", "", "") for k in range(40)]
    damaged = turn_repair.damage(as_written(spark, rows, tmp_path))
    plain = {c: plain_repair(r) for c, r in plain_damage(rows).items()}
    for most in (7, 30):
        assert repaired(turn_repair.repair(damaged, scratch, giant_rows=most)) == plain
    assert repaired(turn_repair.repair(damaged, scratch, giant_bytes=50)) == plain


def test_repaired_turns_have_the_wanted_form(spark, scratch, tmp_path):
    damaged = turn_repair.damage(as_written(spark, made_rows(3, 60, 12), tmp_path))
    summary = turn_repair.repair(damaged, scratch)
    for most in (5, 100_000):
        turns = turn_repair.repaired_turns(damaged, scratch, giant_rows=most)
        lines = turns.groupBy("conv_id").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "role", "text"))), lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n").alias("all"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "role"))), lambda x: F.substring(x["role"], 1, 1)), "").alias("initials"))
        both = summary.join(lines, summary.conv_id.eqNullSafe(lines.conv_id), "left").selectExpr("repaired_sha256 = sha2(coalesce(all, ''), 256) AS same", "coalesce(initials, '') RLIKE '^(s?(ua)+)?$' AS fine").collect()
        assert both and all(r["same"] and r["fine"] for r in both)


def test_repair_of_no_rows_and_dropped_rows(spark, scratch, tmp_path):
    empty = as_written(spark, [], tmp_path)
    assert turn_repair.repair(turn_repair.damage(empty), scratch).count() == 0
    gone = spark.createDataFrame([(5, 1, "user", "Hi.", False)], "conv_id long, turn long, role string, text string, present boolean")
    for most in (0, 10):
        assert repaired(turn_repair.repair(gone, scratch, giant_rows=most)) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def plain_trie(rows):
    own: dict = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    mark = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    own = {c: [t[1:] for t in sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, mark(*x[1:])))] for c, r in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members: dict = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = set()
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        inner = {n[:-1] for n in members if n}
        ends = ",".join(str(c) for c in sorted(c for c in convs if paths[c] == node))
        out.add((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(n[:-1] == node for n in members if n),
                 sum(n not in inner for n in below), sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def as_nodes(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = [tuple(r[n] for n in names) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def trie_rows():
    rng = random.Random(8)
    rows = [(c, k, ("user", "assistant")[k % 2], rng.choice(["Hi.", "Yes é.", ""]) if k < 3 else f"t{rng.randint(0, 9)}", "", "") for c in range(1, 150) for k in range(rng.randint(1, 7))]
    rows += [(c, k, "user", "same", "", "") for c in range(200, 300) for k in range(3)]  # copies of one conversation
    rows += [(400, k, "user", f"{k % 7}", "", "") for k in range(300)] + [(405, k, "user", f"{k % 7}", "", "") for k in range(310)]
    return rows + [(500, None, None, None, "", ""), (500, 1, "user", "x" * 100_000, "", ""), (None, 1, "user", "a", "", ""), (501, 1, "a", "a", "", ""), (501, 1, "a", "a", "", "")]


def test_trie_equals_plain_python(spark, scratch, tmp_path):
    rows = trie_rows()
    expected = plain_trie(rows)
    as_written(spark, rows, tmp_path)
    assert as_nodes(queries.op12_prefix_trie(spark, str(tmp_path))) == expected
    paths = prefix_trie.rebuilt(spark.read.parquet(str(tmp_path / "conversations.parquet")), scratch)
    for shards in (2, 9, 60):
        assert as_nodes(prefix_trie.trie(paths, scratch, shards=shards)) == expected


def test_skeleton_is_met_in_many_shards(spark, scratch, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    monkeypatch.setattr(prefix_trie, "SKELETON_TURNS", 3)
    rows = trie_rows()
    paths = prefix_trie.rebuilt(as_written(spark, rows, tmp_path), scratch)
    splitters = prefix_trie._splitters(scratch.write(paths), 20)
    assert len({p for p, _ in splitters}) < len(splitters) <= 19 and max(len(p) for p, _ in splitters) <= 48
    assert as_nodes(prefix_trie.trie(paths, scratch, shards=20)) == plain_trie(rows)


def test_trie_of_few_rows(spark, scratch, tmp_path):
    empty = as_written(spark, [], tmp_path)
    assert prefix_trie.trie(prefix_trie.rebuilt(empty, scratch), scratch).count() == 0
    one = spark.createDataFrame([(7, 1, "user", "Hi")], "conv_id long, turn long, role string, text string")
    assert as_nodes(prefix_trie.trie(prefix_trie.rebuilt(one, scratch), scratch)) == plain_trie([(7, 1, "user", "Hi")])
