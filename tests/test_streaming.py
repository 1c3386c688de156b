"""Incremental listing ingest: two file drops, the later record wins."""

from __future__ import annotations

import json
import os
import time

from propspark.streaming.listings import current_listings, start_listing_ingest


def _drop(path, recs, mtime):
    with open(path, "w", encoding="utf-8") as f:
        json.dump(recs, f)
    os.utime(path, (mtime, mtime))


def test_two_drops_last_record_wins(spark, tmp_dir):
    inp, log, ck = (os.path.join(tmp_dir, x) for x in ("in", "log", "ck"))
    os.makedirs(inp)
    now = time.time()
    _drop(os.path.join(inp, "d1.json"), [
        {"id": "A", "prix": 100, "image_principale": "a0", "image_urls": ["a1"]},
        {"id": "B", "prix": {"value": 0, "commission": 50}, "dpe_lettre": "C"}], now - 100)
    q = start_listing_ingest(spark, inp, log, ck)
    q.awaitTermination(120)
    _drop(os.path.join(inp, "d2.json"), [{"id": "A", "prix": 120, "image_principale": ""}], now)
    q = start_listing_ingest(spark, inp, log, ck)
    q.awaitTermination(120)
    t = current_listings(spark, log)
    assert {r.id: r.prix for r in t["annonces"].collect()} == {"A": 120.0, "B": 50.0}
    assert sorted((r.id_annonce, r.url_image) for r in t["images"].collect()) == [("A", "a0"), ("A", "a1")]
