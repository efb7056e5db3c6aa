"""Nearest neighbours, revisits, the pipeline and the entry."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tallyline.llm import graph, multi_index, queries, revisits


def test_neighbours_reach_recall_and_exact_scores(spark, scratch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    points = centres[rng.integers(0, 12, 900)] + 0.3 * rng.normal(size=(900, 16))
    points[500:700] = points[0]  # one vector that many rows repeat
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)] + [
        (2000, None), (2100, [0.0] * 16), (2200, [float("nan")] * 16), (2300, [None] * 16), (2400, [1.0, 2.0]), (None, [1.0] * 16), (3, [float(x) for x in points[3]])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("rank", F.lit("x"))
    got = multi_index.search(table, F.col("vec_id") % 100 == 0, scratch).toPandas()
    hit = 0
    for q in range(0, 900, 100):
        distance = np.sqrt(((points - points[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(900), distance)) if i != q][:10]
        own = got[got["query_id"] == q].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 14)) and np.allclose(own["score"], distance[own["vec_id"]], atol=0, rtol=1e-12)
        assert sorted(zip(own["score"], own["vec_id"], strict=True)) == list(zip(own["score"], own["vec_id"], strict=True))
        hit += len(set(order) & set(own["vec_id"]))
    assert hit >= 0.9 * 90 and set(got["query_id"]) == set(range(0, 900, 100))
    assert set(got.loc[got["query_id"] == 0, "vec_id"]) == set(range(500, 510))
    assert multi_index.search(table.filter("vec_id > 1900"), F.col("vec_id") % 100 == 0, scratch).count() == 0
    few = multi_index.search(table.filter("vec_id < 3"), F.col("vec_id") % 100 == 0, scratch).collect()
    assert [(r["query_id"], r["rank"]) for r in few] == [(0, 1), (0, 2)]


def test_revisits_equal_a_plain_search(spark, scratch):
    rng = random.Random(4)
    captures = []
    for k in range(400):
        url = f"http{'s' * (k % 2)}://www.Site{rng.randint(0, 5) if k % 3 else 0}.org/p{'/' * (k % 2)}?utm_x=1&b=2" if k % 50 else None
        tag = f'"{rng.randint(0, 3)}"' if rng.random() < 0.8 else None
        date = str(rng.randint(0, 2)) if rng.random() < 0.7 else None
        captures.append((k, url, rng.randint(0, 150) if k % 61 else None, 304 if rng.random() < 0.5 else 200 if rng.random() < 0.9 else 500,
                         {n: v for n, v in (("etag", tag), ("last-modified", date), ("content-length", str(k)), ("x", str(k))) if v} if k % 40 else None, "extra"))
    table = spark.createDataFrame(captures, "record_id long, url string, captured long, status int, headers map<string,string>, part string")
    key = {r["record_id"]: r["u"] for r in table.select("record_id", revisits.canonical_url(F.col("url")).alias("u")).collect()}
    got = {r["record_id"]: r for r in revisits.resolve(table, scratch, rows_per_part=30).collect()}
    assert set(got) == {c[0] for c in captures if c[3] == 304}
    for k, _, at, status, headers, _ in captures:
        if status != 304:
            continue
        earlier = [c for c in captures if c[3] == 200 and None not in (at, c[2], key[k]) and key[c[0]] == key[k] and (c[2], c[0]) < (at, k)]
        found = max(earlier, key=lambda c: (c[2], c[0]), default=None)
        mine, theirs = headers or {}, (found[4] or {}) if found else {}
        outcome = "no_response" if not found else None
        if found and "etag" in mine and "etag" in theirs:
            outcome = "resolved" if mine["etag"] == theirs["etag"] else "etag_differs"
        elif found and "last-modified" in mine and "last-modified" in theirs:
            outcome = "resolved" if mine["last-modified"] == theirs["last-modified"] else "date_differs"
        outcome = outcome or "no_validator"
        assert (got[k]["response_id"], got[k]["outcome"]) == (found and found[0], outcome)
        assert got[k]["headers"] == (theirs | {n: v for n, v in mine.items() if n != "content-length"} if outcome == "resolved" else None)
    assert revisits.resolve(table.limit(0), scratch).count() == 0


def test_canonical_url(spark):
    pairs = {"HTTP://www.A.com:80/x/?b=1&a=2&utm_source=f#top": "a.com/x?a=2&b=1", "https://u:p@a.com": "a.com", "http://m.a.com/?ref=x": "m.a.com",
             "mailto:x": "mailto:x", "": "", None: None}
    rows = spark.createDataFrame([(u, v) for u, v in pairs.items()], "u string, v string")
    assert all(r["v"] == r["c"] for r in rows.withColumn("c", revisits.canonical_url(F.col("u"))).collect())


def test_components_and_ranks(spark, scratch):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = dict(graph.components(spark.createDataFrame(chain, "a long, b long"), scratch).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 201: 200}
    rows = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(300)], "i long, k long")
    ranked = graph.rank_in_group(rows, ["k"], [F.col("i")], F.xxhash64("i"), rows_per_part=20).collect()
    for k in (None, 0, 1, 2):
        own = [r["rank"] for r in ranked if r["k"] == k]
        assert sorted(own) == list(range(len(own)))


def test_pipeline_stages_take_effect(spark, docs, none, scratch):
    table = docs.select("doc_id", "text", F.lit("xx").alias("lang"), "source", "n_chars")  # one language leaves no margin to judge
    seen = table
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.write(stage(spark, seen, ""))
        assert stage(spark, none.select(*table.columns), "").count() == 0
        if name != "best_fit_packing":
            assert out.columns == table.columns
        if name == "language_id":
            assert out.filter("lang = 'und' OR text IS NULL").count() == 0
        if name == "line_dedup":
            assert out.filter("doc_id BETWEEN 31 AND 35").count() == 0 and out.filter("doc_id = 5").count() == 1
        seen = out
    assert seen.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0 and seen.count() > 0


def test_entry_registers_each_operator():
    import __spark_entry__ as entry
    names = entry.queries()
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_revisits_of_repeated_rows(spark, scratch):
    pages = spark.createDataFrame([(1, "http://a.org/1", "one"), (2, "http://a.org/2", "two")], "page_id long, url string, html string")
    single = sorted(revisits.resolve(revisits.captures_of_pages(pages), scratch).collect(), key=repr)
    twice = sorted(revisits.resolve(revisits.captures_of_pages(pages.union(pages)), scratch).collect(), key=repr)
    assert len(single) == 2 and twice == sorted(single * 2, key=repr)
    bodies = pages.select((F.col("page_id") * 2).alias("record_id"), F.col("html").alias("body"))
    found = revisits.with_bodies(revisits.resolve(revisits.captures_of_pages(pages), scratch), bodies)
    assert {(r["record_id"], r["body"]) for r in found.collect()} == {(3, "one"), (5, "two")}


def test_repeated_rows_keep_one_line(spark, scratch):
    from tallyline.llm import line_dedup
    docs = spark.createDataFrame([(1, "a long line of words here"), (1, "a long line of words here"), (None, "b line"), (None, "b line")], "doc_id long, text string")
    rows = line_dedup.duplicates(docs, scratch).collect()
    assert len(rows) == 2 and all(r["kept"] and r["n_copies"] == 1 for r in rows)
    assert line_dedup.remove(docs, scratch).count() == 4
