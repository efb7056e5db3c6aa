"""Registered operators against plain Python where an earlier version left part of the job out."""

from __future__ import annotations

import collections
import math
import pathlib
import random
import re
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import prose
from pyspark.sql import functions as F

from tallyline.llm import blocks, graph, katz, langid, packing
from tallyline.llm.queries import op1_katz_backoff, public_vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_op1_keeps_pairs_seen_once(spark, tmp_path):
    rows = [(i, prose(i, 30 + 3 * i)) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    one, two = collections.Counter(), collections.defaultdict(collections.Counter)
    tokens = {i: [*WORD.findall(t.lower()), None] for i, t in rows}
    for i, words in tokens.items():
        if not held[i]:
            for before, w in zip(["<s>", *words], words):
                one[w] += 1
                two[before][w] += 1
    n = sum(one.values())
    d1 = katz.discounts(collections.Counter(one.values()))
    times = collections.Counter(c for x in two.values() for c in x.values())
    d2 = katz.discounts(times)
    assert 0 < d2[1] < 1 and times[1] > 100
    cut = lambda c, d: c * (d[c] if c < len(d) else 1)
    unknown = 1 - sum(cut(c, d1) for c in one.values()) / n
    p1 = lambda w: cut(one[w], d1) / n if one[w] else unknown

    def p(w, h):
        whole = sum(two[h].values())
        left = 1 - sum(cut(c, d2) for c in two[h].values()) / whole if whole else 1
        if left < 1e-12:
            whole, left = whole + 1, 1 / (whole + 1)
        return cut(two[h][w], d2) / whole if two[h][w] else left / (1 - sum(p1(x) for x, c in two[h].items() if c)) * p1(w)

    want = {i: sum(math.log10(p(w, h)) for h, w in zip(["<s>", *words], words)) for i, words in tokens.items()}
    got = {r["doc_id"]: r["score"] for r in op1_katz_backoff(spark, str(tmp_path)).collect()}
    assert any(held.values()) and got == pytest.approx(want)


def test_katz_tables_hold_every_pair(spark, docs, texts, scratch, tmp_path):
    katz.score(docs.withColumn("held_out", F.lit(False)), scratch, str(tmp_path)).count()
    fold = str.maketrans({c: c + 32 for c in range(65, 91)})
    tokens = [[*WORD.findall((t or "").translate(fold)), None] for _, t in texts]
    want = [(1, len({w for x in tokens for w in x}) + 1, sum(map(len, tokens)) + len(tokens)),  # and the begin mark
            (2, len({pair for x in tokens for pair in zip(["<s>", *x], x)}), sum(map(len, tokens)))]
    got = katz.ngrams(spark, str(tmp_path)).groupBy("order").agg(F.count("key"), F.sum("count")).collect()
    assert sorted(map(tuple, got)) == want


def test_language_margin_holds_for_long_texts(spark):
    """A clean text many times as long as the dictionaries keeps its language."""
    rng = random.Random(5)
    words = {lang: ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(200)] for lang, letters in (("aa", "abcdefghijklm"), ("bb", "nopqrstuvwxyz"))}
    say = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    model = langid.fit(spark.createDataFrame([(say(lang, 60), lang) for lang in words for _ in range(40)], "text string, lang string"))
    long = spark.createDataFrame([(say(lang, 400_000), lang) for lang in words], "text string, lang string")
    got = langid.classify(long, model).select("lang", "lang_pred", "accepted").collect()
    assert all(r["lang"] == r["lang_pred"] and r["accepted"] for r in got) and len(got) == 2


def test_katz_blocks_do_not_depend_on_batches(monkeypatch):
    """Texts are read again in batches of another size; blocks must hold the same rows then."""
    monkeypatch.setattr(katz, "BLOCK_BYTES", 100)
    monkeypatch.setattr(katz, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    texts = ["a" * n for n in (40, 60, 0, 30, 70, 1, 250, 5, 99, 2, 100, 100, 0)] + [None, "b"]
    whole = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    cut = lambda size: [(k, t.column("text").to_pylist()) for k, t in katz._blocks(whole.slice(a, size) for a in range(0, len(texts), size))]
    assert cut(1) == cut(2) == cut(5) == cut(len(texts))
    assert [x for _, t in cut(4) for x in t] == texts and len({k for k, _ in cut(4)}) == len(cut(4))


def test_katz_reads_a_block_in_little_more_than_its_arrays():
    """Distinct words and pairs of a block are found without sorting arrays of all its tokens."""
    rng = np.random.default_rng(3)
    tokens = 1_500_000
    names = np.array([f"w{i}" for i in range(50_000)])
    texts = [" ".join(x) for x in names[np.minimum(rng.zipf(1.3, tokens), 50_000) - 1].reshape(-1, 300)] + [None, "", " ", "W0 w0"]
    column = pa.array(texts, pa.large_string())
    tracemalloc.start()
    try:
        own = katz.Block.read(column)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 46 * tokens, peak / tokens
    assert len(own.first) == len(texts) + 1 and own.first[-1] == tokens + len(texts) + 2 and (np.diff(own.words.view(np.int64) ^ np.int64(-2**63)) > 0).all()
    assert (own.pair_word[own.pair] == own.word).all() and (own.pair_context[own.pair][1:300] == own.word[:299]).all()


def test_distinct_equals_unique():
    rng = np.random.default_rng(4)
    for values in (rng.integers(0, 2**64, 5000, np.uint64), rng.integers(0, 9, 700).astype(np.uint64), np.full(5, 2**64 - 1, np.uint64),
                   np.array([0, 2**64 - 1, 0], np.uint64), np.zeros(0, np.uint64)):
        want = np.unique(values, return_index=True, return_inverse=True)
        found, place, first = katz._distinct(values)
        assert (found == want[0]).all() and (first == want[1]).all() and (place == want[2]).all()


def test_packing_reads_few_texts_at_a_time(spark, scratch, monkeypatch):
    """Tasks that tokenise hold ``graph.BATCH`` texts at a time."""
    def sizes(docs, *settings):
        return docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"row": [b.num_rows]}) for b in batches), "row long")

    monkeypatch.setattr(packing, "pieces", sizes)
    monkeypatch.setattr(packing, "pack", lambda parts, size: parts.withColumn("n", F.col("row")))
    docs = spark.range(4 * graph.BATCH, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    got = [r["n"] for r in packing.pack_documents(docs, None, scratch).collect()]
    assert got == [graph.BATCH] * 4


def test_encoder_makes_the_slow_tokenizer_only_where_needed():
    encode = packing.Encoder(public_vocabulary())
    plain = encode("plain words, it's  \n all")
    assert "exact" not in vars(encode) and len(encode("plain words")) and "exact" in vars(encode)
    assert plain == np.array(encode.exact.encode("plain words, it's  \n all", add_special_tokens=False).ids, "<u4").tobytes()


def test_tasks_return_freed_memory():
    """What a task has freed goes back to the system, also below memory that is still held."""
    held_now = lambda: int(re.search(r"RssAnon:\s+(\d+)", pathlib.Path("/proc/self/status").read_text())[1]) / 1024
    kept = []

    def run(batches):
        for n in batches:
            arrays = [np.ones(12_000) for _ in range(n)]
            kept.append(np.ones(12_000))
            yield len(arrays)

    before = held_now()
    assert list(blocks.returning(run)(iter([2000]))) == [2000]
    assert held_now() - before < 60 and len(kept) == 1
