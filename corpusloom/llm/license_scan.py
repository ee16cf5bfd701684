"""License scan: MinHash bands over overlapping windows, then exact shingle containment.

Each template of n words has its own windows: n + n/4 words, one beginning every n/4 words,
so every passage of n words lies whole in a window. A window's 5-word shingles (a template of
fewer words is one shingle) get BANDS minimum hashes, one to a band. A window holding the
template has similarity 0.6 or more with it, so it's retrieved with probability over
1 - 0.4 ** BANDS; a shared band only proposes, and the template counts as found where at
least THRESHOLD of its shingles are in the window.

Windows without any of KEYWORDS are skipped: those words are chosen so that each template
shingle has one of them, so such a window can't contain a single shingle of any template.

Only DataFrame functions are used. The templates are a fixed list, so the band table that is
broadcast is bounded.

Edge cases: null and empty texts have no match; a text shorter than a template has one short
window; repeated rows get equal results; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .native import ascii_lower, words
from .textkit import stored, table

SHINGLE = 5
BANDS = 20
THRESHOLD = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Wordings of licence notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
_COMMON = frozenset("a all an and any are as at by for form from in is it of on or possible subject that the this to was with without v 2 0 3 4 nc work free person following under".split())


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9\x80-\U0010ffff]+", text.lower()) if w]


def shingles_of(w: list[str]) -> list[str]:
    g = min(SHINGLE, len(w))
    return sorted({" ".join(w[i : i + g]) for i in range(len(w) - g + 1)})


def keywords() -> list[str]:
    """Words such that each shingle of each template has one, found greedily."""
    left = {s for t in TEMPLATES.values() for s in shingles_of(template_words(t))}
    chosen = []
    while left:
        counts: dict[str, int] = {}
        for s in left:
            for w in set(s.split()):
                counts[w] = counts.get(w, 0) + 1
        best = min(counts, key=lambda w: (w in _COMMON, -counts[w], w))
        chosen.append(best)
        left = {s for s in left if best not in s.split()}
    return sorted(chosen)


KEYWORDS = keywords()


def specs() -> dict[str, tuple[int, int, int, int]]:
    """For each template: words, shingle width, window step, window words."""
    out = {}
    for name, text in TEMPLATES.items():
        n = len(template_words(text))
        step = max(1, n // 4)
        out[name] = (n, min(SHINGLE, n), step, n + step)
    return out


def _shingles(w: Column, g: int) -> Column:
    """Hashes of the distinct g-word shingles; none if there are fewer words."""
    starts = F.when(F.size(w) >= g, F.sequence(F.lit(1), F.size(w) - (g - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(w, i, g), " "))))


def _minima(shingles: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda s: F.struct(s.alias("band"), F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, s))).alias("low")))


def _template_bands(spark: SparkSession) -> DataFrame:
    """(spec, band, low, template, grams) for every template; at most templates * BANDS rows."""
    rows = [(name, template_words(text), "-".join(map(str, specs()[name][1:]))) for name, text in TEMPLATES.items()]
    out = None
    for g in sorted({s[1] for s in specs().values()}):
        part = spark.createDataFrame([r for r in rows if specs()[r[0]][1] == g], "template string, w array<string>, spec string")
        part = part.select("template", "spec", _shingles(F.col("w"), g).alias("grams"))
        out = part if out is None else out.unionByName(part)
    return out.select("spec", "template", "grams", F.inline(_minima(F.col("grams"))))


def find_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, template, percent): the best containment of each template found."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    possible = F.regexp_like(text, F.lit(rf"(?<![a-z0-9])(?:{'|'.join(KEYWORDS)})(?![a-z0-9])"))
    near = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("low")).where(possible)
    near = near.select("doc_id", "text_hash", words(F.col("low"), SEPARATORS).alias("w"))
    known = F.array(*(F.lit(k) for k in KEYWORDS))
    places = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.array_contains(known, F.get("w", i)))
    # Written once: every window size below reads it, and it's what few documents pass.
    near = stored(near.where(F.size("w") > 0).select("doc_id", "text_hash", "w", places.alias("places")), "near")

    windows = None
    for g, step, length in sorted({s[1:] for s in specs().values()}):
        cells = -(-length // step)
        starts = F.array_distinct(F.flatten(F.transform("places", lambda p: F.transform(F.sequence(F.lit(0), F.lit(cells - 1)), lambda k: ((F.floor(p / step) - k) * step).cast("int")))))  # noqa: B023
        part = near.select("doc_id", "text_hash", F.explode(F.filter(starts, lambda s: s >= 0)).alias("start"), "w")
        part = part.select("doc_id", "text_hash", _shingles(F.slice("w", F.col("start") + 1, length), g).alias("here"), F.lit(f"{g}-{step}-{length}").alias("spec"))
        windows = part if windows is None else windows.unionByName(part)
    banded = windows.where(F.size("here") > 0).select("doc_id", "text_hash", "spec", "here", F.inline(_minima(F.col("here"))))
    proposed = banded.join(F.broadcast(_template_bands(docs.sparkSession)), ["spec", "band", "low"])
    common = F.size(F.array_intersect("here", "grams"))
    checked = proposed.select("doc_id", "text_hash", "template", F.floor(100 * common / F.size("grams")).alias("percent"))
    return checked.where(F.col("percent") >= int(100 * THRESHOLD)).groupBy("doc_id", "text_hash", "template").agg(F.max("percent").alias("percent"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_licenses and licenses (template:percent, by name, comma-joined) of every document."""
    found = find_licenses(docs)
    listed = found.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.concat_ws(":", "template", F.col("percent").cast("string")))).alias("names"))
    d, f = docs.select("doc_id", F.xxhash64("text").alias("text_hash")).alias("d"), listed.alias("f")
    joined = d.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.text_hash") == F.col("f.text_hash")), "left")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return joined.select("d.doc_id", F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """Every window on each template's grid, by positions of the template's shingles."""
    grams = [(name, g, step, length, len(shingles_of(template_words(TEMPLATES[name]))), s) for name, (_, g, step, length) in specs().items() for s in shingles_of(template_words(TEMPLATES[name]))]
    values = ", ".join(f"('{n}', {g}, {step}, {length}, {total}, '{s}')" for n, g, step, length, total, s in grams)
    return rf"""
WITH t(template, g, step, len, total, gram) AS (VALUES {values}),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT doc_id, g, p, array_to_string(w[p + 1 : p + g], ' ') AS gram
  FROM (SELECT doc_id, w, g, unnest(range(0, len(w) - g + 1)) AS p FROM d, (SELECT DISTINCT g FROM t) WHERE len(w) >= g)),
hit AS (SELECT doc_id, template, step, len, total, gram, g, p FROM grams JOIN t USING (g, gram)),
inside AS (SELECT doc_id, template, total, gram, s FROM (SELECT *, unnest(range(0, len // step + 1)) AS k, (p // step - k) * step AS s FROM hit) WHERE s >= 0 AND p + g <= s + len),
best AS (SELECT doc_id, template, max(pct) AS pct FROM (SELECT doc_id, template, s, (100 * count(DISTINCT gram)) // total AS pct FROM inside GROUP BY doc_id, template, s, total) WHERE pct >= 80 GROUP BY 1, 2),
l AS (SELECT doc_id, count(*) AS n, string_agg(template || ':' || pct::BIGINT::VARCHAR, ',' ORDER BY template || ':' || pct::BIGINT::VARCHAR) AS names FROM best GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(names, '') AS licenses FROM d LEFT JOIN l USING (doc_id)
"""
