"""Operators on documents against brute force, with odd rows of every kind."""

from __future__ import annotations

import collections
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import altered, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.llm import blocks, jaccard_join, katz, langid, line_dedup, mixing, packing, quality_ftrl, quality_rules
from tallyline.llm.queries import held_out, public_vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({c: c + 32 for c in range(65, 91)})


def roots(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[root(a)] = root(b)
    return [root(x) for x in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aB *\n\té#", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_are_those_of_the_pattern(some, limit):
    got = []
    for _, data, offsets in blocks.text_slices(pa.array(some, pa.string()), limit):
        start, end, rows, hashes = blocks.words(data, offsets)
        for r in range(len(offsets) - 1):
            got.append([bytes(data[a:b]).decode() for a, b, x in zip(start, end, rows, strict=True) if x == r])
        assert len({h: 0 for h in hashes}) == len({bytes(data[a:b]).lower() for a, b in zip(start, end, strict=True)})
    assert got == [WORD.findall(t or "") for t in some]


def test_clusters_equal_brute_force(docs, texts, none, scratch):
    sets = []
    for _, text in texts:
        w = WORD.findall((text or "").translate(FOLD))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = roots(len(sets), links)
    least = {r: min((texts[i][0] for i in range(len(sets)) if root[i] == r and texts[i][0] is not None), default=None) for r in root}
    want = collections.Counter((texts[i][0], len(sets[i]), least[root[i]]) for i in range(len(sets)))
    assert collections.Counter(map(tuple, jaccard_join.clusters(docs, scratch).collect())) == want
    assert jaccard_join.clusters(none, scratch).count() == 0
    kept = jaccard_join.keep_one(docs, scratch)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(57) == 1 and not {31, 32, 33, 34, 35} & set(ids) and {5, 50, 51, 52, 55} <= set(ids)


def test_keep_one_under_repeated_and_null_ids(spark, scratch):
    a, b = prose(500, 80), prose(501, 80)
    near = a + " more"
    kept = lambda rows: sorted(jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string"), scratch).select(
        "doc_id", "text").collect(), key=repr)
    assert kept([(3, a, "x"), (7, b, "x"), (7, near, "x")]) == sorted([(3, a), (7, b)], key=repr)
    assert len(kept([(None, a, "x"), (None, near, "y"), (None, b, "x")])) == 2
    assert kept([(None, near, "x"), (9, a, "x"), (9, a, "y"), (4, "", "x"), (4, "", "y"), (5, None, "x")]) == sorted([(9, a), (4, ""), (4, ""), (5, None)], key=repr)


def test_katz_equals_direct_recursion_and_sums_to_one(docs, texts, none, scratch, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(katz, "BUCKET_BYTES", 4000)
    got = katz.score(docs.withColumn("held_out", held_out(10, 0)), scratch).collect()
    held = {(r["doc_id"], r["text"]): r["h"] for r in docs.select("doc_id", "text", held_out(10, 0).alias("h")).collect()}
    token = lambda t: [*WORD.findall((t or "").translate(FOLD)), None]
    one, two = collections.Counter(), collections.defaultdict(collections.Counter)
    for i, t in texts:
        if not held[i, t]:
            before = "<s>"
            for w in token(t):
                one[w] += 1
                two[before][w] += 1
                before = w
    n, v = sum(one.values()), len(one)
    d1 = katz.discounts(collections.Counter(one.values()))
    d2 = katz.discounts(collections.Counter(c for x in two.values() for c in x.values()))
    cut = lambda c, d: c * (d[c] if c < len(d) else 1)
    unknown = 1 - sum(cut(c, d1) for c in one.values()) / n
    p1 = lambda w: cut(one[w], d1) / n if one[w] else unknown

    def context(h):
        kept = {w: c for w, c in two[h].items()}
        if not kept:
            return 1.0, {}, 1
        all_ = sum(two[h].values())
        left, more = 1 - sum(cut(c, d2) for c in kept.values()) / all_, 0
        if left < 1e-12:
            left, more = 1 / (all_ + 1), 1
        return left / (1 - sum(p1(w) for w in kept)), kept, all_ + more

    def p(w, h):
        back, kept, whole = context(h)
        return cut(kept[w], d2) / whole if w in kept else back * p1(w)

    for h in ("<s>", *list(two)[:4]):
        assert sum(p(w, h) for w in one) + context(h)[0] * unknown == pytest.approx(1, abs=1e-12)
    want = []
    for i, t in texts:
        words, score, base, before = token(t), 0.0, 0.0, "<s>"
        for w in words:
            score += math.log10(p(w, before))
            base += math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1)))
            before = w
        want.append((str(i), held[i, t], len(words), sum(one[w] > 0 for w in words), n, round(base, 6), round(score, 6)))
    assert sorted((str(r[0]), *r[1:5], round(r[5], 6), round(r[6], 6)) for r in got) == sorted(want)
    assert katz.score(none.withColumn("held_out", F.lit(False)), scratch).count() == 0
    taught_nothing = katz.score(docs.withColumn("held_out", F.lit(True)), scratch).agg(F.max("score"), F.min("score")).first()
    assert tuple(taught_nothing) == (0.0, 0.0)


def test_discounts_fall_back_where_good_turing_fails():
    assert katz.discounts({}) == (0.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    assert katz.discounts({1: 10})[0] == 0.0
    assert all(0 < d <= 1 for d in katz.discounts({1: 5, 2: 50, 4: 1})[1:])


def test_language_by_compression(spark, docs, none):
    rows = [(i, ("der die und nicht ein werden " if i % 2 else "los las que por una como ") * (1 + i % 5) + str(i), "de" if i % 2 else "es") for i in range(60)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(labelled.filter("doc_id < 40"))
    assert sorted(model) == ["de", "es"]
    got = langid.classify(labelled.filter("doc_id >= 40"), model).collect()
    assert all(r["lang"] == r["lang_pred"] and r["accepted"] and 0.5 < r["score"] <= 1 for r in got)
    odd = langid.classify(docs, model)
    assert odd.columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score", "accepted"] and odd.count() == docs.count()
    for r in odd.collect():
        unknown = not re.search(r"[^\W\d_]", r["text"] or "")
        assert (r["lang_pred"] == "und") == unknown and (not unknown or (r["score"] == 0 and not r["accepted"]))
    assert langid.classify(none, model).count() == 0
    assert langid.fit(none) == {} and {r["lang_pred"] for r in langid.classify(docs, {}).collect()} == {"und"}
    assert langid.fit(labelled) == langid.fit(labelled.repartition(7))


def test_rules_count_as_defined(docs, texts, none):
    got = quality_rules.judge(docs, quality_rules.Model(np.zeros(quality_rules.DIMENSION), 0.0, 1.0, 1.0)).collect()
    want = []
    for i, t in texts:
        t = t or ""
        w, seen, lines = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                lines += line in seen
                seen.add(line)
        times, covered = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2)), set()
        for k in range(len(w) - 2):
            if times[tuple(w[k:k + 3])] > 1:
                covered |= {k, k + 1, k + 2}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((str(i), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), lines, len(covered), failed, not failed))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in got) == sorted(want)
    assert quality_rules.judge(none, quality_rules.Model(np.zeros(quality_rules.DIMENSION), 0.0, 1.0, 0.0)).count() == 0


def test_classifiers_learn_and_hold_on_unseen_rows(spark, docs, none):
    rows = [(i, prose(i, 80) if i % 3 else " ".join(w + "!!" for w in prose(i, 80).upper().split()), int(i % 3 > 0)) for i in range(240)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = table.select("doc_id", "quality").unionByName(spark.createDataFrame([(None, 1), (3, None), (7, 5)], "doc_id long, quality int"))
    sample = quality_ftrl.labelled_sample(table.drop("quality").filter("doc_id < 160"), labels, "quality", 100)
    assert 40 <= sample.count() <= 140
    held = table.filter("doc_id >= 160")
    for r in quality_ftrl.classify(held, quality_ftrl.fit(sample)).collect():
        assert r["predicted"] == r["quality"] and 0 <= r["score"] <= 1
    for r in quality_rules.judge(held, quality_rules.fit(sample)).collect():
        assert r["kept"] == (r["quality"] == 1 and not r["base_failed"])
    flat = quality_ftrl.classify(docs, quality_ftrl.fit(sample.limit(0))).collect()
    assert {r["score"] for r in flat} == {0.5} and len(flat) == docs.count()
    assert quality_rules.fit(sample.limit(0))[1:] == (0.0, 1.0, 0.0)
    assert quality_ftrl.classify(none, quality_ftrl.fit(sample.limit(0))).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_layout_is_best_fit_decreasing(lengths):
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [b for b in range(len(bins)) if bins[b] >= x]
        if fit:
            bins[min(fit, key=lambda b: bins[b])] -= x
        else:
            bins.append(64 - x)
    used = collections.defaultdict(list)
    for length, _, many, first, offset in packing.layout(collections.Counter(lengths), 64):
        for k in range(many):
            used[first + k].append((offset, length))
    for parts in used.values():
        assert [o for o, _ in sorted(parts)] == list(np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1])
    assert sorted(bins) == sorted(64 - sum(n for _, n in p) for p in used.values())


def test_packing_keeps_every_token(docs, texts, none, scratch):
    from tokenizers import Tokenizer

    vocabulary = public_vocabulary()
    exact = Tokenizer.from_str(vocabulary.tokenizer)
    got = packing.pack_documents(docs, vocabulary, scratch, size=256, with_ids=True).toPandas()
    want = collections.Counter((str(i), tuple([*exact.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in texts)
    whole = collections.Counter()
    for i, part in got.groupby(got["doc_id"].map(lambda x: "None" if x != x else str(int(x)))):
        heads = part[part["piece"] == 0]
        if len(heads) == len(part):
            whole.update((i, tuple(ids)) for ids in heads["ids"])
        else:
            once = part.drop_duplicates(["piece", "ids_crc32"]).sort_values("piece") if i == "57" else part.sort_values("piece")
            whole.update({(i, tuple(x for ids in once["ids"] for x in ids)): len(part) // len(once)})
    assert whole == want
    long = got[got["doc_id"] == 57]
    assert set(long.loc[long["piece"] > 0, "length"]) == {256}
    placed = got.sort_values(["sequence_id", "offset"])
    assert ((placed.groupby("sequence_id")["length"].cumsum() - placed["length"]) == placed["offset"]).all()
    assert placed.groupby("sequence_id")["length"].sum().max() <= 256
    assert packing.pack_documents(none, vocabulary, scratch).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=5), st.integers(0, 60), st.integers(1, 80))
def test_budget_is_met_as_nearly_as_possible_from_below(counts, budget, span):
    take = mixing.fit_budget(counts, budget, span)
    got = sum(n * t for n, t in take.items())
    assert all(0 <= t <= counts[n] for n, t in take.items()) and got <= budget
    assert got >= min(budget, sum(n * c for n, c in counts.items())) - max(counts, default=0)
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    exact = mixing.fit_budget(counts, budget)
    assert sum(n * t for n, t in exact.items()) == max(s for s in sums if s <= budget) and all(0 <= t <= counts[n] for n, t in exact.items())


def test_mix_meets_targets(docs, texts, none, scratch):
    rows = mixing.mix(docs, scratch).collect()
    assert len(rows) == len(texts)
    size = {s: sum(len(WORD.findall(t or "")) for k, (_, t) in enumerate(texts) if ("s1", "s2", None, "s1")[k % 4] == s) for s in ("s1", "s2", None)}
    weight, total = {"s1": 5, "s2": 2, None: 1}, sum(size.values())
    goal, open_ = {}, dict(weight)
    while True:
        left = total - sum(goal.values())
        over = [s for s in open_ if left * open_[s] / sum(open_.values()) > 3 * size[s]]
        if not over:
            goal |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
            break
        for s in over:
            goal[s] = 3 * size[s]
            del open_[s]
    taken = collections.Counter()
    for r in rows:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source"]] += r["taken"]
    for s in goal:  # as near from below as any choice of documents comes
        whole, sums = min(int(goal[s] // size[s]), 3), {0}
        for k, (_, t) in enumerate(texts):
            if ("s1", "s2", None, "s1")[k % 4] == s:
                sums |= {x + len(WORD.findall(t or "")) for x in sums}
        assert taken[s] == whole * size[s] + (max(x for x in sums if x <= int(goal[s]) - whole * size[s]) if whole < 3 else 0)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(docs.repartition(5), scratch).collect()))
    applied = mixing.apply_mix(docs, scratch)
    assert applied.columns == docs.columns
    assert applied.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] == sum(taken.values())
    assert mixing.apply_mix(none, scratch).count() == 0


def test_lines_keep_one_of_each_component(spark, docs, none, scratch):
    base = [prose(700 + i, 40) for i in range(6)]
    rows = [(i, base[i % 6] + "\n" + altered(base[(i + 1) % 6], i, 0.01) + "\nshort") for i in range(18)] + [(None, base[0]), (5, base[5]), (90, None), (91, " \n ")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.duplicates(table, scratch).collect()
    lines = [(i, n, line) for i, t in rows for n, line in enumerate((t or "").split("\n")) if line.strip()]
    grams = [{x[k:k + 8] for k in range(len(x) - 7)} or {x} for x in (line.translate(FOLD) for _, _, line in lines)]
    links = [(a, b) for a in range(len(lines)) for b in range(a) if len(grams[a] & grams[b]) >= 0.75 * len(grams[a] | grams[b])]
    root, groups = roots(len(lines), links), collections.defaultdict(list)
    for k, r in enumerate(root):
        groups[r].append(k)
    first = {r: min(((lines[k][0] is None, lines[k][0] or 0, lines[k][1]) for k in g)) for r, g in groups.items()}
    want = sorted((str(lines[k][0]), lines[k][1], len(groups[r]), first[r][1], first[r][2]) for k, r in enumerate(root))
    assert sorted((str(r["doc_id"]), r["line"], r["n_copies"], r["keeper_doc_id"], r["keeper_line"]) for r in got) == want
    assert sum(r["kept"] for r in got) == len(groups)
    left = line_dedup.remove(table, scratch).collect()
    assert sorted(line for r in left for line in (r["text"] or "").split("\n") if line.strip()) == sorted(
        line for i, t in rows for n, line in enumerate((t or "").split("\n")) if line.strip() and any(
            r["kept"] and r["doc_id"] == i and r["line"] == n and r["row"] == row for r in got for row in [hash_of(spark, t)]))
    assert {90, 91} <= {r["doc_id"] for r in left}
    odd = line_dedup.remove(docs, scratch)
    assert odd.columns == docs.columns and odd.filter("n_chars <> length(text)").count() == 0
    assert line_dedup.remove(none, scratch).count() == 0


def hash_of(spark, text, known={}):  # noqa: B006
    if text not in known:
        known[text] = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).first()[0]
    return known[text]


@pytest.mark.parametrize("cell, long", [(512, 2000), (6, 2000), (512, 60)])
def test_lines_of_large_regions_meet_whole(spark, scratch, monkeypatch, cell, long):
    """Chains, stars and strangers that share regions: cut regions, matrix cells and long lines give brute force's components."""
    monkeypatch.setattr(line_dedup, "LONG", long)
    base = [prose(900 + i, 14) for i in range(5)]
    texts = [altered(base[i % 5], i, 0.01 + 0.05 * (i % 4)) for i in range(90)] + [base[0] + " " + prose(i, 1) for i in range(20)] + ["ab" * 400, "ab" * 40, "ab" * 4]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["keeper_doc_id"] for r in line_dedup.duplicates(table, scratch, bands=40, rows=1, cell=cell).collect()}
    grams = [{x[k:k + 8] for k in range(len(x) - 7)} for x in (t.translate(FOLD) for t in texts)]
    links = [(a, b) for a in range(len(texts)) for b in range(a) if len(grams[a] & grams[b]) >= 0.75 * len(grams[a] | grams[b])]
    root = roots(len(texts), links)
    first = {}
    for k, r in enumerate(root):
        first.setdefault(r, k)
    assert got == {k: first[r] for k, r in enumerate(root)}
    assert 5 < len(first) < len(texts)


def test_regions_of_the_same_lines_are_compared_once(spark, scratch, monkeypatch):
    """Near copies share many bands; their texts travel with one region for each different group of lines."""
    rows = [(i, altered(prose(960 + i % 4, 40), i, 0.002 * (i // 4))) for i in range(8)] + [(8, prose(960, 40))]
    groups, linked = [], line_dedup._linked

    def seen(lines, *more):
        held = lines.groupBy("region").agg(F.array_sort(F.collect_set("node")).alias("g")).collect()
        groups.extend(tuple(r["g"]) for r in held)
        return linked(lines, *more)

    monkeypatch.setattr(line_dedup, "_linked", seen)
    got = line_dedup.duplicates(spark.createDataFrame(rows, "doc_id long, text string"), scratch).collect()
    assert sorted((r["doc_id"], r["keeper_doc_id"], r["n_copies"]) for r in got) == [(i, i % 4, 3 if i % 4 == 0 else 2) for i in range(9)]
    assert len(groups) == len(set(groups)) > 0


def test_packed_keys_are_cut_finer(spark, scratch, monkeypatch):
    """Keys packed while lines are read give the same regions in few buckets and in many; rows that repeat a text count once."""
    rows = [(i, altered(prose(980 + i % 4, 40), i, 0.002 * (i // 4))) for i in range(12)] + [(20, prose(980, 40)), (20, prose(980, 40)), (None, prose(981, 40))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(repr, line_dedup.duplicates(table, scratch).collect()))
    assert len(want) == 14 and sum("n_copies=4" in r for r in want) == 8
    cut, used = line_dedup._cut, []
    monkeypatch.setattr(line_dedup, "_cut", lambda finer: used.append(finer) or cut(finer))
    monkeypatch.setattr(line_dedup, "ENTRIES", 1)
    monkeypatch.setattr(line_dedup, "BUCKETS", 4)
    assert sorted(map(repr, line_dedup.duplicates(table, scratch).collect())) == want
    assert used == [4] * line_dedup.TURNS


def test_lines_reach_python_in_small_batches(spark, scratch):
    """Texts of no more than ``BATCH`` rows are in a worker at a time; the session keeps its own setting."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    with line_dedup._small_batches(spark):
        sizes = scratch.write(spark.range(0, 4000, 1, 1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"]) for b in batches), "n long"))
    assert sorted(r["n"] for r in sizes.collect()) == [line_dedup.BATCH] * 4
    assert spark.conf.get(name) == own


def test_a_pair_is_read_in_one_region_only(monkeypatch):
    """Of near lines that share several regions the texts are cut into shingles where the pair is compared, not in each region."""
    words, coded, seen = [prose(990, 30), prose(990, 30) + " x"], line_dedup._coded, []
    monkeypatch.setattr(line_dedup, "_coded", lambda column, chars: seen.append(len(column)) or coded(column, chars))
    shared = [{"band": b, "region": 7 + b, "size": 2} for b in range(3)]
    table = pa.table({"region": [7, 7, 8, 8, 9, 9], "cell": [0] * 6, "band": [0, 0, 1, 1, 2, 2], "node": [1, 2] * 3, "all": [shared] * 6, "words": words * 3})
    a, b = line_dedup._forest(table, 75, 8, 16, True)
    assert (a.tolist(), b.tolist(), seen) == ([1], [2], [2])


def test_lines_read_in_characters_and_bytes():
    """Line places, also where a byte sequence is no UTF-8 but has as many characters as bytes."""
    for texts in ([b"a\n\n \t\nB\x0bc", b"", b"\xc3\xa9\nx"], [b"ab", b"\xff\x9f\ny"]):
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([0, *map(len, texts)])
        folded, start, end, text, number = line_dedup._lines(data, ends)
        got = [(int(t), int(k), "".join(map(chr, folded[a:b]))) for a, b, t, k in zip(start, end, text, number, strict=True)]
        try:
            plain = [x.decode() for x in texts]
        except UnicodeDecodeError:
            plain = [x.decode("latin-1") for x in texts]
        assert got == [(i, k, x.lower().replace("\x0b", " ")) for i, t in enumerate(plain) for k, x in enumerate(t.split("\n")) if x.strip()]


def test_packs_of_shingle_sets_follow_rows(monkeypatch):
    """Sets are the same in any slices, and no more than ``ROWS`` texts are held at a time."""
    texts = pa.array([prose(i, 30 + i) for i in range(40)] + [None, "", "a b"])
    want = [x.tolist() for x in blocks.shingle_sets(texts, 5)]
    assert [x.tolist() for x in blocks.shingle_sets(texts, 5, 500)] == want
    monkeypatch.setattr(jaccard_join, "ROWS", 10)
    assert [b.num_rows for b in jaccard_join._pieces([pa.RecordBatch.from_arrays([texts], ["text"])])] == [10, 10, 10, 10, 3]
