"""Exact duplicates, URL rules, shards and licences on small fixtures."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from propspark.llm import exact_sort, license_rules, ranges, shards, url_rules


def texts(seed=5, n=400):
    rng = random.Random(seed)
    pool = ["hot text " * 20, "", "é" * 70 + "1", "é" * 70 + "2"] + ["t%d" % k for k in range(60)]
    rows = [(k, pool[0] if k % 3 == 0 else rng.choice(pool)) for k in range(n)]
    return rows + [(n, None), (n + 1, "x" * 200_000), (7, rows[7][1]), (None, "t1"), (None, None)]


@pytest.mark.parametrize("target", [50, 5000, 1 << 30])
@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_groups(spark, monkeypatch, target, keep):
    monkeypatch.setattr(ranges, "MAX_SPLITTERS", 15)  # ranges and hash parts
    rows = texts()
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, kept int").repartition(3)
    out = exact_sort.exact_groups(df, keep=keep, target_bytes=target).collect()
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    pick = max if keep == "max" else min
    want = {t: pick((i for i in ids if i is not None), default=None) for t, ids in by.items()}
    assert len(out) == len(rows)
    for r in out:
        t = r["row"]["text"] or ""
        assert (r["keep_id"], r["group_size"]) == (want[t], len(by[t]))
        assert r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
        assert not r["kept"] or r["row"]["doc_id"] == want[t]
    assert Counter(r["text_sha256"] for r in out if r["kept"]) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in by})
    left = exact_sort.drop_exact(df, keep=keep)
    assert left.columns == df.columns and left.count() == len(by)
    assert exact_sort.exact_groups(df.limit(0)).count() == 0


def test_normalised_texts_are_one_group(spark):
    df = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id long, text string")
    out = exact_sort.exact_groups(df, normalise=F.lower).collect()
    assert sorted((r["row"]["doc_id"], r["keep_id"], r["group_size"]) for r in out) == [(1, 2, 2), (2, 2, 2), (3, 3, 1)]


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a-b.com", "", "block"), ("b.com", "/x", "allow"),
         ("", "/all", "block"), ("Example.ORG", "/es/ok", "allow"), (None, "/", "block")]


def judge(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for h, p, verdict in RULES:
        if h is not None:
            h = h.lower()
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                best = max(best or (-1, -1, "", ""), (len(h) + len(p), len(h), h + p, verdict))
    return (host, path, *(best[2:] if best else (None, "allow")))


@pytest.mark.parametrize("target", [3, 40, 10_000])
def test_url_rules(spark, monkeypatch, target):
    monkeypatch.setattr(ranges, "MAX_SPLITTERS", 31)
    rng = random.Random(2)
    hosts = ["org", "x.org", "example.org", "EXAMPLE.org", "a.example.org", "notexample.org", "a-b.com", "z.a-b.com",
             "b.com", "c.b.com", "com", "", "example.org.", ".com", "com-x.b.com", "Ä.com"]
    paths = ["", "/", "/es/", "/es", "/en/12?x=/fr/", "/fr/1#a", "/de/", "?q=/es/", "#/de/", "/x", "/all", "/es/okay", "/fr"]
    urls = [rng.choice(["http://", "HTTPS://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(300)]
    urls += ["http://example.org/en/1"] * 150 + [None, "", "nothing", "://", "a://b://c/de/", "mailto:x@b.com/x"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = url_rules.judge_urls(pages, rules, target_rows=target).collect()
    assert len(out) == len(urls)
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judge(r["row"]["url"]), r["row"]["url"]
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    assert url_rules.judge_urls(pages, rules.limit(0)).filter("verdict != 'allow' OR rule IS NOT NULL").count() == 0


def test_bulk_quotas_equal_one_by_one():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 9)
        classes = sorted(((rng.randint(1, 50), rng.randint(1, 400)) for _ in range(rng.randint(1, 8))), reverse=True)
        heap, want = [(0.0, j) for j in range(n)], []
        for size, count in classes:
            for _ in range(count):
                load, j = heap[0]
                heapq.heapreplace(heap, (load + size, j))
            want.append(sorted(x for x, _ in heap))
        loads = [0.0] * n
        for (size, count), quota, after in zip(classes, shards.lpt_quotas([(float(s), c) for s, c in classes], n), want):
            assert sum(quota) == count
            loads = [x + q * size for x, q in zip(loads, quota)]
            assert sorted(loads) == after


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(shards, "PIECE_GROUPS", 8)
    monkeypatch.setattr(shards, "SLOT_ROWS", 4)
    rows = [(i, t) for i, t in texts(9) if t is None or len(t) < 1000]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, size int")
    out = shards.assign_shards(df, 7).collect()
    assert len(out) == len(rows)
    slots, where, load = defaultdict(list), defaultdict(set), Counter()
    for r in out:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    for _, s in slots.items():
        assert sorted(s) == list(range(len(s)))
    crc = {zlib.crc32((t or "").encode()): t or "" for _, t in rows}
    for r in out:
        where[r["text_crc32"]].add(r["shard"])
        assert r["size"] == len(crc[r["text_crc32"]].encode()) + 8
    assert all(len(s) == 1 for s in where.values())
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 8
    heap = [(0, j) for j in range(7)]
    for size in sorted(groups.values(), reverse=True):
        x, j = heap[0]
        heapq.heapreplace(heap, (x + size, j))
    assert max(load.values()) <= max(x for x, _ in heap) * 1.01
    assert shards.assign_shards(df.limit(0)).count() == 0


def test_licences(spark):
    apache = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in "
              "compliance with the License.\nSomething else here. You may obtain a copy of the License at\n\n http://x")
    rows = [(1, "Intro. " + apache), (2, "Licensed under the Apache License, Version 2.0."), (3, None), (4, ""),
            (5, "ALL RIGHTS RESERVED!\nall rights reserved"), (6, "not all rights reserved"), (None, "Released under the MIT License."),
            (7, "x " * 50000 + "\nThis work is licensed under the GNU General Public License, version 3.")]
    df = spark.createDataFrame([(i, t, "l") for i, t in rows], "doc_id long, text string, licence string")
    got = sorted((str(r["doc_id"]), r["licence"], r["n_matches"], r["first_sentence"])
                 for r in license_rules.scan_licences(df).collect())
    assert got == [("1", "Apache-2.0", 1, 1), ("2", "Apache-2.0", 1, 0), ("5", "proprietary", 2, 0),
                   ("7", "GPL-3.0", 1, 1), ("None", "MIT", 1, 0)]
    longest = license_rules.scan_licences(df, rules=[("long", ["apache2_grant", "apache2_may", "apache2_copy"]),
                                                     ("short", ["apache2_grant"])]).collect()
    assert sorted((r["doc_id"], r["licence"]) for r in longest) == [(1, "long"), (2, "short")]
    assert license_rules.scan_licences(df.limit(0)).count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
"""
GPL = """This program is free software%s you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation%s either version %d of the License, or
(at your option) any later version.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""


@pytest.mark.parametrize("sign", ["", " * ", "# "])
def test_real_headers_wrapped_over_lines(spark, sign):
    heads = [MIT, BSD, GPL % (";", ";", 2), GPL % (":", ",", 3), APACHE, "...All rights reserved.\n", "All\n\nrights\nreserved"]
    rows = [(k, "Some code\n" + "".join(sign + line + "\n" for line in h.splitlines()) + "int x;") for k, h in enumerate(heads)]
    rows += [(100 + k, " ".join(h.split())) for k, h in enumerate(heads)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in license_rules.scan_licences(df).collect())
    names = ["MIT", "BSD", "GPL-2.0", "GPL-3.0", "Apache-2.0", "proprietary", "proprietary"]
    assert got == [(k, n, 1, 1) for k, n in enumerate(names)] + [(100 + k, n, 1, 0) for k, n in enumerate(names)]
    whole = license_rules.scan_licences(df, rules=[("all", license_rules.RULES[0][1])]).collect()
    assert [r["doc_id"] for r in whole] == [4]  # on one line, two of the sentences are one


def test_dictionary_is_normal_and_used(spark):
    known = [s for alternatives in license_rules.SENTENCES.values() for s in alternatives]
    df = spark.createDataFrame([(s,) for s in known], "s string")
    assert all(r["s"] == r["n"] for r in df.select("s", license_rules.normal(F.col("s")).alias("n")).collect())
    assert {i for _, ids in license_rules.RULES for i in ids} == set(license_rules.SENTENCES)
