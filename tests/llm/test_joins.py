"""Hard negatives, source divergence and the n-gram join against brute force."""

from __future__ import annotations

import math
import os
import random
import re
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from corpusloom.llm import divergence, hard_negatives, ngram_join

DATA = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def against_sql(spark, query, sql, folder=DATA):
    con = duckdb.connect()
    for name in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    got = query(spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.select(*names)) == sorted(cursor.fetchall(), key=repr)


VECTORS = "vec_id long, label int, embedding array<double>, row string, score int, block string, anchor int, side string"


def vectors(spark, items):
    """Rows (vec_id, label, embedding) with columns whose names clash."""
    return spark.createDataFrame([(*x, "r", 1, "b", 2, "s") for x in items], VECTORS)


def mined(items, anchor, label=lambda i, x: x, many=5, negatives=3):
    live = [(i, label(i, x), [math.floor(256 * c) for c in v]) for i, x, v in items if None not in (i, x, v) and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for k, (a, la, va) in enumerate(live):
        if not anchor(a):
            continue
        met = sorted((-sum(x * y for x, y in zip(va, v)), i, m) for j, (i, m, v) in enumerate(live) if j != k)
        for s, p, _ in [x for x in met if x[2] == la][:many]:
            fit = [x for x in met if x[2] != la and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(a, p, r, i, -s, -n) for r, (n, i, _) in enumerate(fit, 1)]
    return sorted(out)


def test_hard_negatives(spark):
    r = random.Random(3)
    shared = [r.uniform(-1, 1) for _ in range(6)]
    items = [(i, r.randrange(3), [r.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    items += [(200 + i, i % 3, shared) for i in range(40)]  # ties
    items += [(300, None, shared), (None, 1, shared), (302, 1, None), (303, 1, [*shared[:5], None]), (304, 1, [*shared[:5], math.inf]), (305, 1, [*shared[:5], math.nan]), (306, 1, shared[:3]), (307, 2, [])]
    wanted = mined(items, lambda i: i % 5 == 0, lambda i, x: (x + 1) % 3 if i % 7 == 0 else x)
    assert len(wanted) > 50
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label"))
    rows = hard_negatives.integer_vectors(vectors(spark, items), label)
    for block in (16384, 16):
        assert rows_of(hard_negatives.mine(rows, F.col("vec_id") % 5 == 0, row_block=block)) == sorted(wanted, key=repr)


def test_hard_negatives_odd_tables(spark):
    def run(items):
        return rows_of(hard_negatives.mine(hard_negatives.integer_vectors(vectors(spark, items), F.col("label")), F.col("vec_id") % 50 == 0))

    assert run([]) == []
    assert run([(50, 1, [1.0])]) == []  # no other row
    assert run([(50, 1, [1.0]), (2, 1, [1.0]), (3, 2, [-1.0])]) == []  # nothing between the limits
    # A row that repeats its id is another row: here the anchor's own copy is its positive.
    assert run([(50, 1, [1.0]), (50, 1, [1.0]), (7, 2, [0.75])]) == [(50, 50, 1, 7, 65536, 49152)] * 2
    # Scores of zero and below: only zero lies between half of zero and 95 % of it.
    assert run([(0, 1, [0.0]), (1, 1, [5.0]), (2, 2, [3.0])]) == [(0, 1, 1, 2, 0, 0)]
    assert run([(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.75])]) == []
    # Too large for exact floats: still exact integers.
    big = float(1 << 21)
    assert run([(0, 1, [big, 1.0]), (1, 1, [big, 1.0]), (2, 2, [big * 0.75, 1 / 256])]) == [(0, 1, 1, 2, (1 << 58) + 65536, 3 * (1 << 56) + 256)]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_hard_negatives_sql(spark):
    against_sql(spark, hard_negatives.op13_hard_negatives, hard_negatives.ORACLE_SQL)


def diverging(items, least, top=10):
    """lang, source, part, item, value, rank by the definitions, every kept term for every group."""
    docs = [tuple(x or "" for x in d) for d in items]
    small = {c: c + 32 for c in range(65, 91)}
    found = [(lang, source, [t.translate(small) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]) for lang, source, text in docs]
    out = []
    for lang in {d[0] for d in docs}:
        df, per = Counter(), {s: Counter() for x, s, _ in found if x == lang}
        for x, source, terms in found:
            if x == lang:
                df.update(set(terms))
                per[source].update(terms)
        kept = [t for t in df if df[t] >= least]

        def weights(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: weights(c) for s, c in per.items()}
        q = weights(sum(per.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in per:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in per if o != s]
            terms = [(-f(p[s][t], q[t]), t) for t in kept if per[s][t] and p[s][t] > q[t]]
            for part, entries, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out += [(lang, s, part, item, -v, k) for k, (v, item) in enumerate(sorted(entries, key=lambda e: (e[0], e[1].encode()))[:most], 1)]
    return sorted(out)


def test_divergence(spark, monkeypatch):
    r = random.Random(5)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randrange(1, 4))) for _ in range(60)] + ["日本", "Ａ", "🙂x", "É"]
    items = [(r.choice(["en", "fr", None]), r.choice("abcde"), " ".join(r.choice(words[: 20 + 8 * (i % 6)]) + r.choice(["", "'S", "9", "-", "\x00", "\n"]) for _ in range(r.randrange(0, 40)))) for i in range(150)]
    items += [("en", "a", None), ("en", "quiet", ""), ("en", "quiet", "123 --"), ("xx", "lonely", "one two"), ("yy", None, None), ("yy", "z", "3"), (None, None, "abc")] + items[:5]
    items += [("en", "a", "ab É日本 Ba " * 30000)]
    clash = "lang string, source string, text string, part string, item string, value int, rank int, term string, p long, n string"
    df = spark.createDataFrame([(*x, "p", "i", 1, 2, "t", 3, "n") for x in items], clash).repartition(5)
    for least in (1, 4, 10, 1000):
        assert rows_of(divergence.divergence(df, least)) == sorted(diverging(items, least), key=repr)
    # Long texts in pieces, shards summed as they fill, and joins without broadcast give the same.
    monkeypatch.setattr(divergence, "PIECE_BYTES", 1000)
    monkeypatch.setattr(divergence, "bounded", lambda frame, rows: frame)
    assert rows_of(divergence.divergence(df, 4)) == sorted(diverging(items, 4), key=repr)
    assert divergence.divergence(df.where("false"), 4).count() == 0


def test_shard_sums_as_it_fills(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "SHARD_ROWS", 10)
    monkeypatch.setattr(divergence, "GATHERED_ROWS", 9)
    batches = [pa.RecordBatch.from_pydict({"lang": ["en"] * 8, "source": ["a"] * 8, "term": list("aabbccdd"), "n": [1] * 8, "docs": [1] * 8}) for _ in range(9)]
    (out,) = divergence._shard(batches, ("SELECT * FROM part ORDER BY term",), divergence._SUM)
    assert out.to_pydict()["term"] == list("abcd") and out.to_pydict()["n"] == [18] * 4


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_divergence_sql(spark):
    against_sql(spark, divergence.op11_source_divergence, divergence.ORACLE_SQL)


def joined(items, width=3, percent=90):
    """doc_id, n_shingles, component_id by all pairs; ids are unique here."""
    sets = {}
    for i, t in items:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(sets[i]), find(i)) for i in sets)


CLASHES = "doc_id long, text string, rep long, tree long, node long, n string, group string, component long, first string, members int, block int, side string"


def texts(spark, items):
    return spark.createDataFrame([(*x, 1, 2, 3, "n", "g", 4, "f", 5, 6, "s") for x in items], CLASHES)


def near_copies(seed, many, chain=0.5):
    """Texts that differ from an earlier one by one word to a tenth of their words."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 7))) for _ in range(300)]
    items = []
    for i in range(many):
        if items and r.random() < 0.8:
            w = (items[-1] if r.random() < chain else r.choice(items))[1].split()
            for _ in range(r.randrange(0, 1 + len(w) // 40)):
                at = r.randrange(len(w))
                w[at : at + r.randrange(0, 2)] = [r.choice(words)] * r.randrange(0, 2)
            items.append((i, " ".join(w)))
        else:
            items.append((i, " ".join(r.choice(words) for _ in range(r.choice([3, 8, 11, 12, 14, 20, 40, 90, 200, 500])))))
    return items


def test_ngram_join(spark):
    odd = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "One  two"), (907, "one two three"), (908, "Étude naïve 日本 🙂"), (909, "étude naïve 日本 🙂")]
    for seed in (1, 2):
        items = near_copies(seed, 260) + odd
        want = joined(items)
        assert len({c for _, _, c in want}) < len(want) - 60
        assert rows_of(ngram_join.jaccard_join(texts(spark, items).repartition(3)).drop("group")) == sorted(want, key=repr)
    items = near_copies(5, 120)
    for width, percent in ((1, 80), (5, 70)):
        assert rows_of(ngram_join.jaccard_join(texts(spark, items), width, percent).drop("group")) == sorted(joined(items, width, percent), key=repr)


def test_ngram_join_odd_rows(spark):
    join = lambda items: rows_of(ngram_join.jaccard_join(texts(spark, items)).drop("group"))
    assert join([]) == []
    long = " ".join(f"w{k % 9973}x{k}" for k in range(40000))
    assert join([(7, long), (3, long + " end"), (9, "w0x0 w1x1 w2x2")]) == [(3, 39999, 3), (7, 39998, 3), (9, 1, 9)]
    text = " ".join(f"v{k}" for k in range(60))
    rows = [(None, text), (None, text), (5, text), (5, "other words here"), (4, text + " z"), (None, "lone text of null id"), (None, None)]
    assert join(rows) == sorted([(None, 58, 4), (None, 58, 4), (5, 58, 4), (5, 1, 5), (4, 59, 4), (None, 3, None), (None, 0, None)], key=repr)


def test_trees_are_searched(spark, monkeypatch):
    """A hot tree over many leaves: two rings of near copies whose members miss the smallest one."""
    monkeypatch.setattr(ngram_join, "LEAF", 8)
    monkeypatch.setattr(ngram_join, "TWIG", 3)
    monkeypatch.setattr(ngram_join, "CONFIRM_BLOCK", 4)
    monkeypatch.setattr(ngram_join, "bounded", lambda frame, rows: frame)
    base = [f"w{k}" for k in range(120)]
    items = [(i, " ".join(w if k < 60 or (k - 60) // 2 != i % 30 else f"x{i}" for k, w in enumerate(base))) for i in range(90)]
    items += [(100 + i, " ".join([*base[:40], *(f"y{k + i}" for k in range(80))])) for i in range(40)]
    assert rows_of(ngram_join.jaccard_join(texts(spark, items)).drop("group")) == sorted(joined(items), key=repr)


def test_tree_search_finds_all_links(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF", 8)
    monkeypatch.setattr(ngram_join, "TWIG", 3)
    r, bands = np.random.default_rng(4), ngram_join.Bands.of(90)
    pool = r.integers(1, 2**63, 9000).astype(np.uint64)
    rows, sets = [], {}
    for tree in (1, 2):
        for rep in range(tree * 100, tree * 100 + 70):
            core = pool[: 100 + rep % 7] if rep % 3 else pool[2000 : 2105]
            at = r.choice(len(core), len(core) - int(r.integers(0, 9)), replace=False)
            sets[rep] = np.sort(np.concatenate([core[at], pool[r.integers(5000, 9000, int(r.integers(0, 4)))]]))
            band = int(bands.of_size(np.array([106]))[0])
            rows.append(((tree << 8) | band, rep % 5 if tree == 1 else 7, len(sets[rep]), rep, bytearray(ngram_join.bitmap(sets[rep], 2 * int(bands.bits[band])).tobytes())))
    frame = spark.createDataFrame(rows, "tree long, component long, n long, rep long, bitmap binary").repartition(3)
    got = rows_of(ngram_join.search_trees(frame, bands))
    assert len(got) == len(set(got))
    across = {(a, b) for a in sets for b in sets if a < b < 200 and a % 5 != b % 5}
    jaccard = lambda a, b: len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b]))
    links = {(a, b) for a, b in across if jaccard(a, b) >= 0.9}
    assert len(links) > 100 and links <= set(got) <= across
    assert len(got) < 0.7 * len(across)


def test_bounds_reject_no_link():
    r = np.random.default_rng(1)
    bands = ngram_join.Bands.of(90)
    pool = r.integers(1, 2**63, 4000).astype(np.uint64)
    for n in (9, 10, 12, 30, 200, 1500):
        a = np.sort(pool[:n])
        for extra in range(0, n // 9 + 2):
            b = np.sort(np.concatenate([pool[extra : n], pool[3000 : 3000 + max(0, extra // 2)]]))
            common = len(np.intersect1d(a, b))
            link = 100 * common >= 90 * (len(a) + len(b) - common)
            if not link:
                continue
            sizes = np.array([len(a), len(b)])
            doc, names = ngram_join.tree_names(np.repeat([0, 1], sizes), np.concatenate([a, b]), sizes, bands)
            assert extra == 0 or set(names[doc == 0]) & set(names[doc == 1])
            bits = int(bands.bits[bands.of_size(sizes.max())])
            maps = [ngram_join.folded(ngram_join.bitmap(x, 4 * bits), bits) for x in (a, b)]
            assert (maps[0] == ngram_join.bitmap(a, bits)).all()
            assert ngram_join.can_link(sizes[:1], sizes[1:], maps[0][None], maps[1][None], 90).all()
            nodes = [ngram_join.Nodes.over(np.array([i]), sizes[i : i + 1], maps[i][None], np.zeros(1, int)) for i in (0, 1)]
            assert ngram_join.may_hold_links(*nodes, 90).all()


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_ngram_join_sql(spark):
    against_sql(spark, ngram_join.op12_ngram_join, ngram_join.ORACLE_SQL)


ODD = [(None, "mail a.b@c.de now", "en", "s"), (None, "mail a.b@c.de now", "en", "s"), (7, None, "en", None), (7, "", None, "s"), (7, "one", "de", "t"), (8, "one two three four five six seven eight nine ten eleven", "en", "s"), (8, "one two three four five six seven eight nine ten eleven", "en", "s"), (9, " \n ", "fr", "s")]


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Documents with null and repeated ids and rows, and columns whose names clash."""
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = spark.createDataFrame([(*x, len(x[1] or "")) for x in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({c: F.lit(None).cast("string") for c in ("rep", "tree", "term", "h1", "score", "label", "block", "part")}).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ODD[5][1]), (None, "null item words"), (3, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(8, 1, 0), (7, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("number", [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12])
def test_null_and_repeated_ids(spark, odd_tables, number):
    """A row for each row, equal ones for equal rows."""
    from corpusloom.llm import registry

    (name,) = (n for n in registry.queries() if n.startswith(f"op{number}_"))
    out = registry.queries()[name](spark, odd_tables)
    got = out.collect()
    assert len(got) == len(ODD) and sorted((r.doc_id for r in got), key=repr) == sorted((x[0] for x in ODD), key=repr)
    if number != 9:
        alike = [tuple(r) for r in got if r.doc_id is None]
        assert alike[0] == alike[1]
