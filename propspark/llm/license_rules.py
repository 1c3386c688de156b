"""Licence scans by sentence rules.

Texts are cut into sentences, each sentence is normalised (lower case, runs
of other characters than letters, digits and dots in numbers become one
space), known sentences become identifiers, and the sequence of identifiers
is matched against ordered rules: a rule fires where its identifiers follow
each other, with at most ``GAP`` unknown sentences in between.  Of rules that
start at the same sentence the one with most sentences wins.

The cut is fine (line ends, ``;`` and ``:`` too), and a known sentence may
span any number of cuts: one that is wrapped over lines, also behind comment
signs, is known from its first piece on.  Of known sentences with the same
first piece the longest counts, and none is taken from the inside of another.

Only DataFrame functions.  The dictionary and the rules are parameters of a
few hundred entries; they are constants of the plan (sentences of the text are
looked up in the dictionary as a join-free array lookup), so the scan is one
pass without a shuffle.

Results for odd input: null and empty texts have no sentences; repeated rows
are scanned each on their own; a null identifier is carried through; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = 2

# ------------------------------------------------------------ fixed values
# Known licence sentences, normalised, by identifier.
SENTENCES = {
    "apache2_grant": ["licensed under the apache license version 2.0",
                      "licensed under the apache license version 2.0 the license"],
    "apache2_may": ["you may not use this file except in compliance with the license"],
    "apache2_copy": ["you may obtain a copy of the license at"],
    "asis": ["unless required by applicable law or agreed to in writing software distributed under the license"
             " is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "mit_name": ["released under the mit license", "licensed under the mit license", "the mit license mit",
                 "this software is released under the mit license"],
    "mit_grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and"
                  " associated documentation files the software to deal in the software without restriction",
                  "permission is hereby granted free of charge to any person obtaining a copy of this software and"
                  " associated documentation files the software to deal in the software without restriction including"
                  " without limitation the rights to use copy modify merge publish distribute sublicense and or sell"
                  " copies of the software and to permit persons to whom the software is furnished to do so subject to"
                  " the following conditions"],
    "gpl3_work": ["this work is licensed under the gnu general public license version 3",
                  "licensed under the gnu general public license version 3"],
    "gpl2_work": ["this work is licensed under the gnu general public license version 2",
                  "licensed under the gnu general public license version 2"],
    "gpl_free": ["this program is free software you can redistribute it and or modify it under the terms of the"
                 " gnu general public license as published by the free software foundation"],
    "gpl2_free": ["this program is free software you can redistribute it and or modify it under the terms of the"
                  " gnu general public license as published by the free software foundation either version 2 of the"
                  " license or at your option any later version"],
    "gpl3_free": ["this program is free software you can redistribute it and or modify it under the terms of the"
                  " gnu general public license as published by the free software foundation either version 3 of the"
                  " license or at your option any later version"],
    "cc_by_nc4": ["licensed under cc by nc 4.0", "this work is licensed under cc by nc 4.0"],
    "cc_by4": ["licensed under cc by 4.0", "this work is licensed under cc by 4.0"],
    "cc_by_sa4": ["licensed under cc by sa 4.0", "this work is licensed under cc by sa 4.0"],
    "cc0": ["this work is dedicated to the public domain", "licensed under cc0 1.0"],
    "reserved": ["all rights reserved"],
    "bsd_redistribution": ["redistribution and use in source and binary forms with or without modification are"
                           " permitted provided that the following conditions are met"],
}
# Rules: licence and the identifiers it asks for, in order.
RULES = [
    ("Apache-2.0", ["apache2_grant", "apache2_may", "apache2_copy", "asis"]),
    ("Apache-2.0", ["apache2_grant", "apache2_may", "apache2_copy"]),
    ("Apache-2.0", ["apache2_grant"]),
    ("MIT", ["mit_name", "mit_grant"]),
    ("MIT", ["mit_name"]),
    ("MIT", ["mit_grant"]),
    ("GPL-3.0", ["gpl3_work"]),
    ("GPL-2.0", ["gpl2_work"]),
    ("GPL-2.0", ["gpl2_free"]),
    ("GPL-3.0", ["gpl3_free"]),
    ("GPL", ["gpl_free"]),
    ("CC-BY-NC-4.0", ["cc_by_nc4"]),
    ("CC-BY-4.0", ["cc_by4"]),
    ("CC-BY-SA-4.0", ["cc_by_sa4"]),
    ("CC0-1.0", ["cc0"]),
    ("BSD", ["bsd_redistribution"]),
    ("proprietary", ["reserved"]),
]
# -------------------------------------------------------- end fixed values


def sentences(text: Column) -> Column:
    """Sentences of a text: cut at line ends and behind ``.``, ``!``, ``?``,
    ``;`` or ``:`` and white space."""
    return F.split(F.coalesce(text, F.lit("")), r"[.!?;:]*\s*\n\s*|[.!?;:]+\s+")


def normal(sentence: Column) -> Column:
    """Lower case; only letters, digits and dots between digits remain."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"(?:[^a-z0-9.]|\.(?![0-9])|(?<![0-9])\.)+", " "))


def sequence_of_ids(cut: Column, dictionary: dict[str, list[str]]) -> Column:
    """Known sentences of a text's pieces, in order: array of struct(at, id,
    last), where ``last`` is the last piece of the sentence."""
    known = [(s, name) for name, alternatives in sorted(dictionary.items()) for s in alternatives]
    keys = F.array(*[F.lit(s) for s, _ in known])
    names = F.array(*[F.lit(n) for _, n in known])
    # A piece that is not empty has a word; as many empty ones are allowed.
    most = 2 * max(len(s.split(" ")) for s, _ in known)
    first = F.array(*[F.lit(w) for w in sorted({re.match("[a-z0-9]+", s).group() for s, _ in known})])
    # Most pieces are dismissed by their first word.
    begins = F.filter(F.transform(cut, lambda s, i: F.struct(i.alias("at"), s.alias("s"))), lambda x: F.array_contains(
        first, F.lower(F.regexp_extract(x["s"], r"[A-Za-z0-9]+", 0))))
    begins = F.transform(begins, lambda x: F.struct(x["at"].alias("at"), normal(x["s"]).alias("s")))
    begins = F.filter(begins, lambda x: F.exists(keys, lambda k: F.startswith(F.concat(k, F.lit(" ")), F.concat(x["s"], F.lit(" ")))))

    def longest(at: Column) -> Column:
        pieces = F.transform(F.slice(cut, at + 1, most), lambda s, i: F.struct(i.alias("i"), normal(s).alias("s")))

        def step(a: Column, x: Column) -> Column:
            text = F.concat_ws(" ", a["text"], x["s"])
            key = F.array_position(keys, text).cast("int")
            return F.struct(text.alias("text"), F.when(key > 0, key).otherwise(a["key"]).alias("key"),
                            F.when(key > 0, x["i"]).otherwise(a["last"]).alias("last"))
        start = F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).alias("key"), F.lit(0).alias("last"))
        return F.aggregate(F.filter(pieces, lambda x: x["s"] != ""), start, step)

    def identify(x: Column) -> Column:
        more = F.exists(keys, lambda k: F.startswith(k, F.concat(x["s"], F.lit(" "))))
        alone = F.struct(x["s"].alias("text"), F.array_position(keys, x["s"]).cast("int").alias("key"), F.lit(0).alias("last"))
        return F.struct(x["at"].alias("at"), F.when(more, longest(x["at"])).otherwise(alone).alias("o"))

    found = F.filter(F.transform(begins, identify), lambda x: x["o"]["key"] > 0)
    return F.transform(found, lambda x: F.struct(x["at"].alias("at"), F.get(names, x["o"]["key"] - 1).alias("id"),
                                                 (x["at"] + x["o"]["last"]).alias("last")))


def _match(ids: Column, cut: Column, rules: list[tuple[str, list[str]]], gap: int) -> Column:
    """Array of struct(at, licence, sentences): rules that fire."""
    def between(before: Column, one: Column) -> Column:
        """Pieces with words between two known sentences."""
        return F.size(F.filter(F.slice(cut, before["last"] + 2, one["at"] - before["last"] - 1), lambda s: normal(s) != ""))

    def fired(licence: str, wanted: list[str]) -> Column:
        def match(x: Column, i: Column) -> Column:
            ok = x["id"] == wanted[0]
            for k, name in enumerate(wanted[1:], 1):
                one, before = F.get(ids, i + k), F.get(ids, i + (k - 1))
                ok = ok & (one["id"] == name) & ((one["at"] - before["last"] <= gap + 1) | (between(before, one) <= gap))
            return F.struct(x["at"].alias("at"), F.lit(licence).alias("licence"),
                            F.lit(len(wanted)).alias("sentences"), F.coalesce(ok, F.lit(False)).alias("ok"))
        return F.filter(F.transform(ids, match), lambda m: m["ok"])

    return F.concat(*[fired(licence, wanted) for licence, wanted in rules])


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  dictionary: dict[str, list[str]] | None = None,
                  rules: list[tuple[str, list[str]]] | None = None, gap: int = GAP) -> DataFrame:
    """One row per licence found in a document: doc_id, licence, n_matches
    and first_sentence (position, from 0)."""
    dictionary = SENTENCES if dictionary is None else dictionary
    rules = RULES if rules is None else rules
    cut = docs.select(F.col(f"`{id_col}`").alias("doc_id"), sentences(F.col(f"`{text_col}`")).alias("cut"))
    ids = cut.select("doc_id", "cut", sequence_of_ids(F.col("cut"), dictionary).alias("ids"))
    ids = ids.filter(F.size("ids") > 0)
    ids = ids.withColumn("ids", F.filter("ids", lambda x: ~F.exists("ids", lambda y: (y["at"] < x["at"]) & (x["at"] <= y["last"]))))
    hits = ids.select("doc_id", _match(F.col("ids"), F.col("cut"), rules, gap).alias("m"))
    best = F.filter("m", lambda x: ~F.exists("m", lambda y: (y["at"] == x["at"]) & (y["sentences"] > x["sentences"])))
    hits = hits.withColumn("m", best)
    # A row's licences are counted within the row: no shuffle.
    each = hits.select("doc_id", "m", F.explode(F.array_distinct(F.transform("m", lambda x: x["licence"]))).alias("licence"))
    own = F.filter("m", lambda x: x["licence"] == F.col("licence"))
    return each.select("doc_id", "licence", F.size(own).alias("n_matches"),
                       F.array_min(F.transform(own, lambda x: x["at"])).alias("first_sentence"))
