"""The training-data operators against brute force, on odd and small inputs."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import components, decontamination, license_scan, media, neardup, pii, quality, sentencepiece_stream, sharding, textkit, token_counts, toxicity

#: Names that the operators use inside, as columns of the input.
CLASHES = {"rep": "long", "key": "long", "text_hash": "long", "n": "long", "score": "double", "ids": "string", "label": "string", "bucket": "int", "term": "string", "base": "string", "h1": "string", "weak_posterior": "double", "draw": "double"}


def frame(spark, items):
    """Documents (doc_id, text) with extra columns whose names clash."""
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in items], "doc_id long, text string, lang string, source string, n_chars long")
    for name, kind in CLASHES.items():
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def vocabulary(seed, n=400):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9))) for _ in range(n)]


def corpus(seed=1, n=40):
    """Documents with near copies, repeated rows, nulls, blanks, ties and a long text."""
    r, words = random.Random(seed), vocabulary(seed)
    items = []
    for i in range(n):
        if i % 3 and items and items[-1][1]:
            w = items[-1][1].split()
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = r.choice(words)
            items.append((i, " ".join(w)))
        else:
            items.append((i, " ".join(r.choice(words) for _ in range(r.randrange(30, 90)))))
    items += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "two words"), (n + 6, "Étude naïve 日本 🙂 x"), (n + 7, " ".join(r.choice(words) for _ in range(30000)))]
    return items + items[:2]


EMPTY: list = []


def links(items, width=2):
    sets = {}
    for i, t in items:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_neardup(spark, seed):
    items = corpus(seed)
    wanted = links(items)
    got = neardup.near_duplicates(frame(spark, items), 2).collect()
    assert len(got) == len(items)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_neardup_five_words(spark):
    items = corpus(4) + [(60, "a b c d"), (61, "A b c d"), (62, "a b c")]
    got = neardup.near_duplicates(frame(spark, items)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == links(items, 5)


def test_neardup_odd_ids(spark):
    """Ids may be null or repeat: rows are told apart by their texts, and no link is lost."""
    r, words = random.Random(21), vocabulary(21)
    a, b, c = (" ".join(r.choice(words) for _ in range(80)) for _ in range(3))
    items = [(1, c), (1, a), (7, a + " one"), (None, b), (None, b + " two too"), (None, a + " three"), (None, None), (None, ""), (2, None), (7, a + " one")]
    got = neardup.near_duplicates(frame(spark, items), 2).collect()
    by = {(x.doc_id, x.n_shingles): x.component_id for x in got}
    n = {t: len({tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)}) for t in (a, b, c, a + " one", a + " three", b + " two too")}
    assert len(got) == len(items) and by[7, n[a + " one"]] == by[None, n[a + " three"]] == by[1, n[a]] == 1
    assert by[None, n[b]] is None and by[None, n[b + " two too"]] is None and by[2, 0] == 2 and by[None, 0] is None
    df = frame(spark, items)
    kept = neardup.deduplicate(df, 2)
    assert kept.columns == df.columns
    rows = sorted(((x.doc_id or 0, x.text or "") for x in kept.collect()))
    wanted = sorted([(1, c), (1, a), (2, ""), (0, "")])
    assert [x for x in rows if not x[1].startswith(b)] == wanted
    assert [x[1] for x in rows if x[1].startswith(b)] in ([b], [b + " two too"])
    assert neardup.deduplicate(frame(spark, EMPTY)).count() == 0


def test_components(spark):
    """A chain in ascending order and a star need few rounds; any graph's labels are right."""
    r = random.Random(2)
    graphs = [[(i, i + 1) for i in range(1000)], [(500, i) for i in range(500)], [(i, 999 - i) for i in range(1000)] + [(5, 6)], [(r.randrange(400), r.randrange(400)) for _ in range(300)], []]
    for edges in graphs:
        root = {}

        def find(x, root=root):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in edges:
            if a != b:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
        rounds = []
        stored = components.stored
        components.stored = lambda df, name, rounds=rounds, stored=stored: (rounds.append(name), stored(df, name))[1]
        try:
            got = {x.node: x.component for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        finally:
            components.stored = stored
        assert got == {x: find(x) for x in root}
        assert rounds.count("edges") <= 6 and rounds.count("step") <= 16


def test_neardup_one_large_group(spark):
    """Many near copies of one text: no link is lost and no square of pairs is needed."""
    r, words = random.Random(5), vocabulary(5)
    base = [r.choice(words) for _ in range(60)]
    items = []
    for i in range(120):
        w = list(base)
        for _ in range(r.randrange(0, 7)):
            w[r.randrange(60)] = r.choice(words)
        items.append((i, " ".join(w)))
    got = {x.doc_id: x.component_id for x in neardup.near_duplicates(frame(spark, items), 2).collect()}
    assert got == {i: c for i, (_, c) in links(items).items()}


def test_neardup_empty(spark):
    assert neardup.near_duplicates(frame(spark, EMPTY)).count() == 0


def test_signature_guarantee():
    """Signatures that differ in no more symbols than guaranteed share an index key."""
    r = np.random.default_rng(3)
    for _ in range(200):
        a = r.integers(0, 1 << 16, neardup.SYMBOLS).astype(np.uint16)
        b = a.copy()
        b[r.choice(neardup.SYMBOLS, neardup.GUARANTEED_DISTANCE, replace=False)] ^= 1
        keys = neardup.index_keys(np.stack([a, b]))
        assert (keys[0] == keys[1]).any()
        shared = np.flatnonzero(keys[0] == keys[1])
        assert neardup.first_shared_key(a[None], b[None]).view(np.uint64)[0] == keys[0][shared[0]]


def test_word_hashes():
    docs = [b"ab cd", b"", b"cd  ab\tcd", "é x".encode()]
    w = textkit.Words(docs)
    h, by = w.hashes(), {}
    for k, (s, e) in enumerate(zip(w.start, w.end, strict=True)):
        by.setdefault(bytes(w.buffer[s:e]), set()).add(int(h[k]))
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by) == 4
    assert list(np.bincount(w.doc, minlength=4)) == [2, 0, 3, 2]


def test_licenses(spark):
    r, words = random.Random(7), vocabulary(7)
    fill = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, f"{fill(r.randrange(0, 50))} {t.upper() if i % 2 else t} {fill(r.randrange(0, 50))}") for i, t in enumerate(license_scan.TEMPLATES.values())]
    items += [(20, fill(300)), (21, None), (22, ""), (23, "licensed"), (24, "licensed under the apache license edition 2"), (25, "All rights reserved. " * 3), (26, fill(20000) + " Released under the MIT License.")]
    found = {}
    for i, t in items:
        w = license_scan.template_words(t or "")
        for name, text in license_scan.TEMPLATES.items():
            _, g, step, length = license_scan.specs()[name]
            wanted = set(license_scan.shingles_of(license_scan.template_words(text)))
            best = max((100 * len(wanted & {" ".join(w[s + k : s + k + g]) for k in range(len(w[s : s + length]) - g + 1)}) // len(wanted) for s in range(0, len(w), step)), default=0)
            if best >= 80:
                found.setdefault(i, []).append(f"{name}:{best}")
    got = {x.doc_id: x.licenses for x in license_scan.scan(frame(spark, items + items[:1])).collect()}
    assert got == {i: ",".join(sorted(found.get(i, []))) for i, _ in items}
    assert all(found.get(i) for i in range(len(license_scan.TEMPLATES)))
    assert license_scan.scan(frame(spark, EMPTY)).count() == 0


def brute_spans(text):
    def luhn(d):
        return sum((v if i % 2 == 0 else v * 2 - 9 * (v > 4)) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0

    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v, d: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v, d: all(int(x) <= 255 for x in v.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda v, d: 13 <= len(d) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v, d: 9 <= len(d) <= 15),
    }
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in checks.items() for m in re.finditer(p, text) if ok(m.group(), re.sub("[^0-9]", "", m.group()))]


def test_personal_data(spark):
    r = random.Random(11)
    bits = ["a@b.c", "x.y@mail.example.com", "a@b.c_d@e.f", "@", "..", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.255.0", "4532015112830366", "4532 0151 1283 0366", "4532-0151-1283-0366", "1234567890123", "+1 (555) 123-4567",
        "+44 20 7946 0958", "+1", "é🙂", "word", "--", "1 2 3", "a%b@c-d.e-f.g", "0000000000000000", " ", "\n", "12345678901234567890 1"]
    items = [(i, "".join(r.choice(bits) + r.choice(["", " ", "x"]) for _ in range(r.randrange(0, 12)))) for i in range(150)]
    items += [(200, None), (201, ""), (202, "7" * 20000), (203, "a" * 20000 + "@b.c"), (204, "a@b.c " * 300)]
    items += items[:2]
    got = pii.find_personal_data(frame(spark, items)).select("doc_id", pii._joined(F.col("base")).alias("s")).collect()
    assert len(got) == len(items)
    wanted = {i: ",".join(brute_spans(t or "")) for i, t in items}
    assert {x.doc_id: x.s for x in got} == wanted
    assert pii.find_personal_data(frame(spark, EMPTY)).count() == 0


def test_disclosing_terms(spark):
    """A word that stands only beside one address gives it away; a common one doesn't."""
    items = [(i, f"call Zanzibarian the owner at who{i % 2}@x.yz about the matter number{i}") for i in range(0, 12, 2)]
    items += [(i, "the owner and the matter are common words about nothing") for i in range(1, 40, 2)]
    df = frame(spark, items)
    terms = {s.value for x in pii.find_personal_data(df).collect() for s in x.terms}
    assert "zanzibarian" in terms and not terms & {"the", "owner", "matter", "about"}
    clean = {x.doc_id: x.text for x in pii.sanitise(df).collect()}
    assert clean[0].startswith("[TERM] [TERM] the owner at [EMAIL] about") or clean[0].startswith("call [TERM]") or "[EMAIL]" in clean[0] and "Zanzibarian" not in clean[0]
    assert clean[1] == dict(items)[1] and pii.sanitise(df).columns == df.columns


def test_single_text_entities_have_terms(spark):
    """An entity that stands in one text is disclosed by the words that stand only there."""
    items = [(None if i == 3 else i, f"ask Quorvath{chr(97 + i) * 3} the owner at u{i}@x.yz about matters") for i in range(8)] + [(i, "ask the owner about matters and nothing else") for i in range(100, 140)]
    got = {x.doc_id: [s.value for s in x.terms] for x in pii.find_personal_data(frame(spark, items)).collect()}
    assert got == {i: [t.split()[1].lower()] if "@" in t else [] for i, t in items}


def test_terms_are_marked_everywhere(spark):
    """A disclosing term goes far from its entity too, and where the entity is not written, but not inside a base span."""
    far = "word " * 300
    items = [(1, f"Quorvath a@b.c {far}QUORVATH, é🙂 quorvath quorvath@x.yz {far}end quorvath"), (2, f"{far}quorvath"), (None, "quorvath")]
    items += [(i, f"a@b.c Quorvath {far}") for i in range(10, 20)] + [(i, "word of nothing end xyz") for i in range(100, 1200)]
    clean = {x.doc_id: x.text for x in pii.sanitise(frame(spark, items)).collect()}
    assert clean[1] == f"[TERM] [EMAIL] {far}[TERM], é🙂 [TERM] [EMAIL] {far}end [TERM]"
    assert (clean[2], clean[None], clean[10]) == (f"{far}[TERM]", "[TERM]", f"[EMAIL] [TERM] {far}")
    assert clean[100] == "word of nothing end xyz"


def test_counts_of_frequent_and_rare_keys(spark):
    pairs = spark.range(5000).select(F.when(F.col("id") < 2000, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    counts = pairs.groupBy("k").agg(F.count("*").alias("n"))
    got = pii._with_counts(pairs, 5000, counts, "k").collect()
    assert sorted((x.k, x.v, x.n) for x in got) == sorted((-1, v, 2000) if v < 2000 else (v, v, 1) for v in range(5000))


def test_sanitise_keeps_rows(spark):
    items = [(1, "mail a@b.c and +1 (555) 123-4567 now"), (1, "mail a@b.c and +1 (555) 123-4567 now"), (2, None), (3, "")]
    got = sorted((x.doc_id, x.text) for x in pii.sanitise(frame(spark, items)).where("doc_id <> 2").collect())
    assert got == [(1, "mail [EMAIL] and [PHONE] now")] * 2 + [(3, "")]


def test_media(spark):
    items = [(1, None), (2, ""), (3, "abc" * 500), (4, "é🙂" * 99), (5, "abc" * 500), (6, "x" * 576)]
    got = {x.doc_id: x for x in media.media_digests(frame(spark, items)).collect()}
    for i, text in items:
        raw = (text or "").encode()
        payload = raw + b"\xff" * ((-len(raw)) % 576 or (0 if raw else 576))
        x = got[i]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        wav = media.write_wav(payload, media.FORMAT_MULAW, media.RATE, 8)
        assert (x.media_bytes, x.media_sha256) == (len(wav), hashlib.sha256(wav).hexdigest()) and media.read_wav(wav) == (7, 8000, payload)
    assert got[3].feature == got[5].feature
    files = {x.doc_id: x for x in media.encode_audio(frame(spark, items)).collect()}
    rate, pcm = media.expand(bytes(files[6].pcm_wav))
    assert rate == 16000 and len(pcm) == 1152 and pcm[0] == media.MULAW[ord("x")]
    assert media.media_digests(frame(spark, EMPTY)).count() == 0


def test_companding_tables():
    assert [int(media.MULAW[i]) for i in (0x00, 0x7F, 0x80, 0xFF)] == [-32124, 0, 32124, 0]
    assert [int(media.ALAW[i]) for i in (0xD5, 0x55, 0xAA, 0x2A)] == [8, -8, 32256, -32256]


def test_adpcm():
    blocks = np.random.default_rng(0).integers(0, 256, (5, 36)).astype(np.uint8)
    got = media.decode_adpcm(blocks)
    for row, block in zip(got, blocks, strict=True):
        value, index = int.from_bytes(bytes(block[:2]), "little", signed=True), min(int(block[2]), 88)
        out = [value]
        for nibble in (n for b in block[4:] for n in (int(b) & 15, int(b) >> 4)):
            step = int(media.ADPCM_STEP[index])
            delta = (step >> 3) + (step if nibble & 4 else 0) + (step >> 1 if nibble & 2 else 0) + (step >> 2 if nibble & 1 else 0)
            value = max(-32768, min(32767, value - delta if nibble & 8 else value + delta))
            index = max(0, min(88, index + int(media.ADPCM_INDEX[nibble])))
            out.append(value)
        assert list(row) == out


def test_sentencepiece(spark):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_stream.DEFAULT_MODEL)
    r = random.Random(2)
    items = corpus(3, 12) + [(90, "  two  spaces "), (91, "ñandú, ça_va² x_{i}\n\n\tend"), (92, "a" * 3000), (93, "".join(chr(r.randrange(1, 0x3000)) for _ in range(300)))]
    got = {x.doc_id: x for x in sentencepiece_stream.encode_documents(frame(spark, items)).collect()}
    for i, text in items:
        assert got[i].ids == sp.encode(text or "") and got[i].n_tokens == len(got[i].ids) and got[i].round_trip, text
    back = {x.doc_id: x.text for x in sentencepiece_stream.decode_documents(sentencepiece_stream.encode_documents(frame(spark, items))).collect()}
    assert all(back[i] == (t or "") for i, t in items)
    assert sentencepiece_stream.encode_documents(frame(spark, EMPTY)).count() == 0


def unigram_model(pieces):
    """A model file with the given (piece, score)."""
    import struct

    def field(n, kind, body):
        return bytes([n << 3 | kind]) + (bytes([len(body)]) + body if kind == 2 else body)

    out = b""
    for piece, score, kind in [("<unk>", 0.0, 2), *((p, s, 1) for p, s in pieces)]:
        out += field(1, 2, field(1, 2, piece.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))
    return out + field(2, 2, field(3, 0, b"\x01")) + field(3, 2, field(3, 0, b"\x00"))


def test_unigram_stream():
    """Committed ids are those of the best whole segmentation, and memory stays bounded."""
    r = random.Random(4)
    pieces = [(c, -4.0 - 0.01 * k) for k, c in enumerate("abc")] + [("".join(r.choice("abc") for _ in range(n)), -r.uniform(3, 9)) for n in (2, 2, 3, 3, 4, 5)]
    pieces = list(dict(pieces).items())
    codec = sentencepiece_stream.Codec(unigram_model(pieces))
    scores = {p: float(np.float32(s)) for p, s in pieces}
    for _ in range(30):
        text = "".join(r.choice("abc") for _ in range(r.randrange(1, 120)))
        best = [0.0] + [float("-inf")] * len(text)
        for e in range(1, len(text) + 1):
            best[e] = max(best[s] + scores[text[s:e]] for s in range(max(0, e - 5), e) if text[s:e] in scores)
        parts = list(codec.stream(text))
        ids = [i for part in parts for i in part]
        assert "".join(codec.pieces[i] for i in ids) == text
        assert sum(scores[codec.pieces[i]] for i in ids) == pytest.approx(best[-1])
    assert len(list(codec.stream("abc" * 200))) > 10


def test_quality(spark):
    r, words = random.Random(8), vocabulary(8)
    short = ["a", "of", "to", "in", "the"]
    prose = lambda n: " ".join((r.choice(short) if r.random() < 0.35 else r.choice(words)) + ("." if r.random() < 0.08 else "") for _ in range(n)).capitalize()
    good = [(i, prose(r.randrange(30, 200))) for i in range(160)]
    bad = [(200 + i, " ".join(w + r.choice(["***", "%%%", "$$$"]) for w in prose(60).split())) for i in range(12)]
    bad += [(220 + i, " ".join(w.upper() + "!!" for w in prose(40).split())) for i in range(12)]
    bad += [(240 + i, " | ".join(x for x in r.choices(words, k=50) if len(x) > 4)) for i in range(12)]
    odd = [(300, None), (301, ""), (302, " \n "), (303, good[0][1])]
    df = frame(spark, good + bad + odd + good[:1])
    kept = quality.reject(df)
    assert kept.columns == df.columns
    ids = sorted(x.doc_id for x in kept.collect())
    assert ids == sorted([i for i, _ in good] + [303, 0])
    assert quality.reject(frame(spark, EMPTY)).count() == 0


def brute_hits(items, benchmark):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = {}
    for item, text in benchmark:
        w = words(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[s : s + 10]), set()).add(str(item))
    out = {}
    for i, text in items:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def test_decontamination(spark):
    r, words = random.Random(9), vocabulary(9, 60)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    benchmark = [(i, text(r.randrange(11, 25))) for i in range(12)] + [(20, "Tiny item"), (21, ""), (22, None), (23, "...")]
    benchmark += [benchmark[0], (30, benchmark[1][1].upper())]
    items = [(i, f"{text(20)}, {benchmark[i % 12][1].title()}! {text(r.randrange(5, 30))}") for i in range(20)]
    items += [(50, text(200)), (51, None), (52, ""), (53, "TINY--item"), (54, " ".join(benchmark[3][1].split()[:9])), (55, "İé Σ " + benchmark[2][1]), (56, text(20000) + " " + benchmark[5][1])]
    items += items[:2]
    items_b = spark.createDataFrame(benchmark, "item_id long, text string").withColumn("window", F.lit("x"))
    got = decontamination.contamination(frame(spark, items), items_b).collect()
    assert len(got) == len(items)
    assert {x.doc_id: (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in got} == brute_hits(items, benchmark)
    assert decontamination.contamination(frame(spark, EMPTY), items_b).count() == 0
    clean = decontamination.contamination(frame(spark, items), items_b.limit(0)).collect()
    assert len(clean) == len(items) and not any(x.contaminated for x in clean)


def test_proximity(spark):
    docs = frame(spark, [(1, "alpha beta extra gamma"), (2, "gamma far far far far far far far far alpha"), (3, "alpha beta gamma")])
    windows, _ = decontamination.benchmark_windows(spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string"))
    terms = spark.createDataFrame([(t, k) for k, t in enumerate(("alpha", "beta", "gamma"))], "term string, term_id long")
    index = decontamination.build_index(docs, terms, 3)
    rows = decontamination.anchors(windows, terms, index.groupBy("term_id").agg(F.count("*").alias("f")))
    assert {x.doc_id for x in decontamination.proximity(index, rows, 3, 2).collect()} == {1, 3}
    assert {x.doc_id for x in decontamination.candidates(index, rows, 3).collect()} == {3}


def test_edit_counts(spark):
    tokens = token_counts.counter(token_counts.DEFAULT_RANKS)
    r, parts = random.Random(6), ["a", "b", " ", "  ", "\n", "'", "'re", "12", ".", "!!", "é", "日", "don't", "\t"]
    draw = lambda n: "".join(r.choice(parts) for _ in range(n))
    for _ in range(300):
        doc = token_counts.EditableDocument(draw(r.randrange(0, 1500)), tokens)
        for _ in range(5):
            start = r.randrange(0, len(doc.text) + 2)
            end, new = start + r.choice([0, 1, 5, 300]), draw(r.choice([0, 1, 4, 400]))
            wanted = doc.text[:start] + new + doc.text[end:]
            assert doc.edit(start, end, new) == tokens.count(wanted) and doc.text == wanted
    items = corpus(4, 10)
    got = {x.doc_id: x for x in token_counts.count_tokens(frame(spark, items)).collect()}
    for i, text in items:
        after = text or ""
        for start, end, new in token_counts.revision(text or ""):
            after = after[:start] + new + after[end:]
        assert (got[i].n_tokens, got[i].edited_tokens, got[i].edited_crc32) == (tokens.count(text or ""), tokens.count(after), zlib.crc32(after.encode()))
        assert got[i].reencoded < 60
    assert token_counts.count_tokens(frame(spark, EMPTY)).count() == 0


def test_pre_token_pattern():
    tokens = token_counts.counter(token_counts.DEFAULT_RANKS)
    text = "I'll don't they've 12ab  x\n\n y!! 'quoted' é"
    assert sum(map(tokens.of, tokens.pieces(text))) == len(tokens.encoding.encode_ordinary(text)) and "".join(tokens.pieces(text)) == text


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_permutation(n):
    rows = np.arange(n)
    places = sharding.permute(rows, n, 7)
    assert sorted(places) == list(rows) and list(sharding.unpermute(places, n, 7)) == list(rows)
    assert n < 1000 or (places != rows).mean() > 0.9


def test_sharding(spark):
    items = [(i * 7, f"text {i % 5}") for i in range(500)] + [(None, "null id"), (1, None), (2, ""), (2, ""), (2, "")]
    out = sharding.assign_shards(frame(spark, items)).collect()
    assert len(out) == len(items)
    by = {}
    for x in out:
        by.setdefault(x.shard, []).append(x.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted((x.doc_id or -1, x.size, x.text_crc32) for x in out) == sorted((i or -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in items)
    again = sharding.assign_shards(frame(spark, items[::-1]).repartition(3)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    assert sharding.assign_shards(frame(spark, EMPTY)).count() == 0


def channel():
    texts = [("the stupid idiot is a moron and the good people of the town are kind to all " * 40).encode()]
    return toxicity.Channel(toxicity.trigram_counts(texts))


@pytest.mark.parametrize(("token", "wanted"), [("st.up1d", "stupid"), ("1d10t", "idiot"), ("m0r0n", "moron"), ("s t u p i d", "stupid"), ("stuuuupid", "stupid"), ("id-iot", "idiot"), ("$tup!d", "stupid")])
def test_restore(token, wanted):
    assert channel().restored_tokens(f"you {token} there").split() == [wanted]


@pytest.mark.parametrize(("token", "wanted"), [("stu" + "u" * 70 + "pid", "stupid"), ("idio+", "idiot"), ("idi0+", "idiot"), ("moro|<", "moro"), ("th3", "the"), ("st£upid", "stupid"), ("idio7,", "idiot")])
def test_restore_long_and_at_the_end(token, wanted):
    assert channel().restored_tokens(f"you {token} there").split()[0].startswith(wanted)
    low = f"you {token} there".encode()
    assert toxicity.readable([low], channel())[0] != low


def test_restore_spaced_sentence():
    """No length is left out: a spaced sentence is decoded as a whole, and long junk takes linear time."""
    c = channel()
    text = " ".join("thestupididiotisamoronandthegoodpeople")
    assert len(text) > 64 and c.restored_tokens(text).replace(" ", "") == text.replace(" ", "") and "idiot" in c.restored_tokens(text)
    assert c.restored_tokens("st.upid" * 3000).startswith("stupidstupid")
    assert c.restored_tokens("7" * 100000) == "" and c.restored_tokens("ab" * 50000) == ""


def test_hint_is_a_superset():
    r = random.Random(12)
    parts = ["a", "b", "zz", "é", "É", "日", "€", "£", "$", "!", "3", "|<", ".", ",", " ", "\u00a0", "\x1c", "\n", "-", "_", "…", "(", ")", "²"]
    for _ in range(40000):
        low = "".join(r.choice(parts) for _ in range(r.randrange(1, 9))).encode().translate(textkit.LOWER)
        assert toxicity._HINT.search(low) or not toxicity._SUSPECT.search(low.decode()), low


def test_restore_leaves_words():
    assert channel().restored_tokens("the good people of the town, kind to all. 1995 a b") == ""


def test_toxicity(spark):
    r, words = random.Random(10), vocabulary(10)
    items, labels = [], []
    for i in range(400):
        w = [r.choice(words) for _ in range(40)]
        if i % 5 == 0:
            w[3] = r.choice(["zlorp", "vexgrub", "zlooorp"])
        items.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 5 == 0)))
    items += [(900, None), (901, ""), (902, "zlorp " * 20000), (0, items[0][1])]
    docs, marks = frame(spark, items), spark.createDataFrame([*labels, (0, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, toxicity.train(docs, marks)).collect()
    assert len(out) == len(items) and all(0 <= x.score <= 1 for x in out)
    kind = {i: t for i, _, t in labels}
    out_of_sample = [x for x in out if x.doc_id in kind and zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert np.mean([(x.score >= 0.5) == kind[x.doc_id] for x in out_of_sample]) > 0.95
    by = {x.doc_id: x.score for x in out}
    assert by[902] > 0.5 > by[901] == by[900]
    none = toxicity.train(docs, marks.limit(0))
    assert {round(x.score, 6) for x in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(frame(spark, EMPTY), none).count() == 0


def test_toxicity_with_few_labels(spark):
    """Nothing is commoner in the toxic documents: every document scores their share."""
    r = random.Random(12)
    items = [(i, " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(12))) for i in range(100)] + [(None, "null id"), (200, None), (201, "")]
    rows = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5]
    for toxic in (rows[:4], rows[:1]):
        marks = spark.createDataFrame([(i, 1, int(i in toxic)) for i in rows[: 20 * len(toxic)]], "doc_id long, quality int, toxic int")
        got = toxicity.score(frame(spark, items), toxicity.train(frame(spark, items), marks)).collect()
        assert len(got) == len(items) and {round(x.score, 9) for x in got} == {0.05}
    three = spark.createDataFrame([(rows[0], 1, 1), (rows[1], 1, 0), (rows[2], 1, 0)], "doc_id long, quality int, toxic int")
    assert {round(x.score, 6) for x in toxicity.score(frame(spark, items), toxicity.train(frame(spark, items), three)).collect()} == {0.333333}


def test_registered_sql_is_text():
    from corpusloom.llm import registry

    assert set(registry.oracle_sql()) <= set(registry.queries()) and all(isinstance(x, str) for x in registry.oracle_sql().values())


def test_windows_are_bounded(spark, monkeypatch):
    """Committed parts add up to the model's ids when the tables of steps are dropped all the time, and one window is held."""
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_stream.DEFAULT_MODEL)
    monkeypatch.setattr(sentencepiece_stream, "_STEPS", 50)
    monkeypatch.setattr(sentencepiece_stream, "_WORDS", 7)
    with open(sentencepiece_stream.DEFAULT_MODEL, "rb") as f:
        codec = sentencepiece_stream.Codec(f.read())
    r = random.Random(6)
    for _ in range(60):
        text = "".join(r.choice(["a", "the", "ing", " ", "  ", "\n", "é", "日", "!!", "▁", "x", "re"]) for _ in range(r.randrange(0, 80)))
        assert codec.encode(text) == sp.encode(text), text
    assert max(len(w.held) for w in codec._windows.values()) <= 2 * codec.longest
    parts = list(codec.stream("▁" + "banana▁bread▁" * 50))
    assert len(parts) > 50 and sum(parts, []) == sp.encode("banana bread " * 50)


def brute_terms(items):
    """Disclosing terms by their definition, over whole texts."""
    rows, seen = [], set()
    for i, t in items:
        t = t or ""
        base = [(m, *map(int, m.split(":")[1:])) for m in brute_spans(t)]
        words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_]{3,}", t)]
        clear = [(w, s, e) for w, s, e in words if not any(b < e and s < f for _, b, f in base)]
        near = set()
        for m, b, f in base:
            lo, hi = max(0, b - 80), min(len(t), f + 80)
            if lo > 0:
                lo += len(re.match(r"\S*", t[lo:b]).group())
            if hi == f + 80:
                hi -= len(re.search(r"\S*$", t[f:hi]).group())
            entity = f"{m.split(':')[0]}:{t[b:f].lower()}"
            near.add((entity, None))
            near |= {(entity, w) for w, s, e in clear if (lo <= s and e <= b) or (f <= s and e <= hi)}
        rows.append((set(() if (i, t) in seen else near), {w for w, _, _ in words}, clear))
        seen.add((i, t))
    total = len(items)
    n_t = lambda w: sum(w in r[1] for r in rows)
    n_p = lambda p: sum(p in r[0] for r in rows)
    out = set()
    for entity, w in set().union(*(r[0] for r in rows)):
        n_e = n_p((entity, None))
        if w is not None and n_p((entity, w)) * total > n_t(w) * n_e and n_p((entity, w)) / n_t(w) >= 0.6:
            out.add(w)
    return [sorted((s, e, w) for w, s, e in r[2] if w in out) for r in rows]


def test_terms_by_brute_force(spark):
    r, words = random.Random(31), vocabulary(31, 120)
    people = [("Ann" + "".join(r.choice("abcdefgh") for _ in range(4)), f"p{k}@mail{k}.org") for k in range(12)]
    items = []
    for i in range(70):
        w = [r.choice(words) for _ in range(r.randrange(5, 60))]
        for _ in range(r.randrange(0, 3)):
            name, mail = r.choice(people)
            w.insert(r.randrange(len(w) + 1), r.choice([f"{name} {mail}", f"{mail},{name}", f"{name}", f"é{mail}ééé", f"{name} 10.0.0.{r.randrange(3)}", f"tel+44 20 7946 0958 {name}"]))
        items.append((i, " ".join(w)))
    items += [(80, None), (81, ""), items[3], (None, items[4][1])]
    wanted = brute_terms(items)
    assert sum(map(len, wanted)) > 10
    got = {}
    for x in pii.find_personal_data(frame(spark, items)).collect():
        got[x.doc_id, x.text_hash] = [(s.start, s.end, s.value) for s in x.terms]
    ids = [r.h for r in spark.createDataFrame([(k, t or "") for k, (_, t) in enumerate(items)], "k int, t string").orderBy("k").select(F.xxhash64("t").alias("h")).collect()]
    assert all(got[i, h] == want for (i, _), h, want in zip(items, ids, wanted, strict=True))


def test_terms_do_not_depend_on_the_size_of_the_table(spark):
    """What is marked in a text stays when texts without any of its words are added."""
    items = [(i, f"Quorvath{chr(97 + i)} u{i}@x.yz shared{chr(97 + i // 3)} words") for i in range(9)] + [(20, "sharedb of nobody"), (21, "quorvatha quorvathb here")]
    more = [(i, "nothing of that kind stands in these") for i in range(100, 3100)]
    marked = []
    for rows in (items, items + more):
        got = pii.find_personal_data(frame(spark, rows)).where("size(terms) > 0").collect()
        marked.append(sorted((x.doc_id, [s.value for s in x.terms]) for x in got))
    assert marked[0] == marked[1]
    # One text beside the address and one without is no disclosure: a and b stay.
    assert marked[0] == [(i, [f"quorvath{chr(97 + i)}"]) for i in range(2, 9)]


def test_terms_too_many_to_broadcast(spark, monkeypatch):
    """Shuffled, with a word in every text and a disclosing word in a third of all, the same."""
    hot = [(i, f"the owner Zanzibarian who@x.yz and the rest number{i}") for i in range(0, 300, 3)]
    items = hot + [(i, f"the owner of the rest number{i}") for i in range(300) if i % 3] + [(400 + i, f"the Ann{chr(97 + i)} u{i}@x.yz") for i in range(5)]
    results = []
    for rows in (pii.native.BROADCAST_ROWS, 1):
        monkeypatch.setattr(pii.native, "BROADCAST_ROWS", rows)
        found = pii.find_personal_data(frame(spark, items)).collect()
        results.append(sorted((x.doc_id, [(s.start, s.end, s.value) for s in x.terms]) for x in found))
    assert results[0] == results[1]
    marked = {i: [v for _, _, v in t] for i, t in results[0]}
    assert all("zanzibarian" in marked[i] for i, _ in hot) and marked[400] == ["anna"]
    assert not any({"the", "owner", "rest"} & set(t) for t in marked.values())


def test_filter_has_every_term(spark):
    words = spark.range(3000).select(F.concat(F.lit("w"), "id").alias("term"))
    may_be = pii._may_be(words.where("term < 'w2'"))
    got = words.withColumn("passes", F.exists(F.array("term"), may_be)).collect()
    assert all(x.passes for x in got if x.term < "w2") and sum(x.passes for x in got if x.term >= "w2") < 20
    assert not words.where(pii._may_be(words.limit(0))(F.col("term"))).count()


def test_the_filter_is_no_part_of_the_plan(spark):
    """It has 65,536 words, and the driver prints each plan again and again."""
    items = [(i, f"kestrel wrote to a{i % 3}@example.org today") for i in range(30)]
    found = pii.find_personal_data(frame(spark, items))
    assert len(found._jdf.queryExecution().toString()) < 500_000


def test_many_entities_in_one_text(spark):
    """Work grows with the text, not with the square of what is found in it."""
    n = 20000
    text = " ".join(f"a{i}@b.cd" for i in range(n))
    df = frame(spark, [(1, text), (2, "x " * 1500 + "one a1@b.cd and +44 20 7946 0958 end")])
    got = {x.doc_id: x for x in pii.find_personal_data(df).collect()}
    assert [(s.start, s.end) for s in got[1].base] == [m.span() for m in re.finditer(r"\S+", text)]
    clean = {x.doc_id: x.text for x in pii.sanitise(df).collect()}
    assert clean[1] == " ".join(["[EMAIL]"] * n)
    assert "[EMAIL]" in clean[2] and "[PHONE]" in clean[2] and "@" not in clean[2]


def test_sanitise_keeps_clashing_columns(spark):
    items = [(1, "mail a@b.c now"), (2, None), (3, "none")]
    df = frame(spark, items).withColumn("text_hash", F.lit(5)).withColumn("cuts", F.lit("kept")).withColumn("c.d", F.lit(7)).withColumn("at", F.col("doc_id") * 2)
    rows = pii.sanitise(df)
    assert rows.columns == df.columns
    got = {x["doc_id"]: x for x in rows.collect()}
    assert all(x["text_hash"] == 5 and x["cuts"] == "kept" and x["c.d"] == 7 and x["at"] == 2 * i for i, x in got.items())
    assert "[EMAIL]" in got[1].text
    assert got[2].text is None and got[3].text == "none"


def test_viterbi_by_enumeration():
    """The decoded string costs no more than any other path of the lattice."""
    c, r = channel(), random.Random(17)

    def price(strings, prices):
        x = y = toxicity._EDGE
        total = sum(prices)
        for char in "".join(strings):
            k = c._class(char)
            total += c.cost[x, y, k]
            x, y = (toxicity._EDGE, toxicity._EDGE) if k == toxicity._EDGE else (y, k)
        return total + c.cost[x, y, toxicity._EDGE]

    for _ in range(150):
        token = "".join(r.choice("stupidom013$@.-é|uu") for _ in range(r.randrange(1, 8)))
        paths = {}
        for arcs in itertools.product(*c.lattice(token)):
            strings, prices = zip(*arcs, strict=True)
            word, cost = "".join(strings), price(strings, prices)
            paths[word] = min(cost, paths.get(word, cost))
        assert paths[c.restore(token)] == pytest.approx(min(paths.values())), token


def test_suspects_take_linear_time():
    import time

    c = channel()
    texts = ["ab" * 250000, "ab,cd;" * 80000, "日本" * 250000, "a-" * 200000 + "aa", "-" * 400000 + "a", "st.upid " + "word," * 80000]
    begin = time.perf_counter()
    for text in texts:
        c.restored_tokens(text)
        toxicity.readable([text.encode()], c)
    assert time.perf_counter() - begin < 60
    assert list(toxicity.suspects("s t u p i d.id-iot good th3 s.t.u.p and")) == ["s t u p i d", "id-iot", "th3", "s.t.u.p"]


def test_toxic_sample_is_bounded(spark):
    """One labelled id over many texts: the fit takes no more rows than asked for, about."""
    docs = spark.range(4000).select(F.lit(1).alias("doc_id"), F.concat(F.lit("zlorp text of number "), F.col("id").cast("string")).alias("text"))
    docs = docs.unionByName(spark.range(300).select((F.col("id") + 2).alias("doc_id"), F.concat(F.lit("a clean text of number "), F.col("id").cast("string")).alias("text")))
    marks = spark.range(302).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") == 1).cast("int").alias("toxic"))
    got = {x.doc_id: x.score for x in toxicity.score(docs, toxicity.train(docs, marks, 200)).collect()}
    assert got[1] > 0.5 > got[7]


def test_expectation_maximisation_by_rows():
    """The estimate from pattern counts is that of a plain loop over rows."""
    r = np.random.default_rng(5)
    k = len(quality.LABELLERS)
    truth = r.random(400) < 0.8
    rows = np.stack([[(int(t) if r.random() < 0.8 else 1 - int(t)) if r.random() < 0.6 else -1 for _ in range(k)] for t in truth]).astype(np.int64)
    codes, counts = np.unique(quality._encode(rows), return_counts=True)
    posterior, accuracy, good = quality.expectation_maximisation(quality._decode(codes), counts.astype(float))
    chance = [[[0.4, 0.35, 0.25] for _ in range(k)], [[0.3, 0.02, 0.68] for _ in range(k)]]
    share, old = 0.85, [0.85] * len(rows)
    for _ in range(300):
        new = []
        for row in rows:
            like = [np.prod([chance[y][j][v + 1] for j, v in enumerate(row)]) * s for y, s in ((0, 1 - share), (1, share))]
            new.append(like[1] / (like[0] + like[1]))
        for y in (0, 1):
            weight = [x if y else 1 - x for x in new]
            for j in range(k):
                for v in range(3):
                    chance[y][j][v] = (sum(w for w, row in zip(weight, rows, strict=True) if row[j] + 1 == v) + (1.0, 0.5, 0.5)[v]) / (sum(weight) + 2)
        for j in range(k):
            chance[1][j][1] = min(chance[1][j][1], chance[0][j][1])
        share = min(max((sum(new) + 9) / (len(rows) + 10), 0.05), 0.995)
        done = max(abs(a - b) for a, b in zip(new, old, strict=True)) < 1e-7
        old = new
        if done:
            break
    by_code = dict(zip(codes.tolist(), posterior, strict=True))
    assert np.allclose([by_code[int(c)] for c in quality._encode(rows)], old, atol=1e-5) and good == pytest.approx(share, abs=1e-5)
    assert np.mean((np.array(old) > 0.5) == truth) > 0.9 and all(0.5 < a < 1 for a in accuracy)


def test_quality_is_reproducible(spark):
    """Scores don't depend on how rows are dealt out, also where the sample is cut and a row repeats."""
    r, words = random.Random(40), vocabulary(40)
    items = [(i, " ".join(r.choice(words) + ("." if r.random() < 0.1 else r.choice(["", "", "***"])) for _ in range(r.randrange(5, 60)))) for i in range(600)]
    items += [(i, " ".join(r.choice(words).upper() + "!!" for _ in range(40))) for i in range(600, 700)] + items[:1] * 300
    got = []
    for parts in (2, 7):
        df = spark.createDataFrame(items, "doc_id long, text string").repartition(parts)
        scorer, _ = quality.train(df, 100)
        assert scorer.weights is not None
        got.append(sorted(quality.score(df, scorer).select("doc_id", "score").collect()))
    assert got[0] == got[1] and len({x.score for x in got[0]}) > 100


def test_variety_at_any_length():
    """A long text that cycles one line of words is as poor as a short one."""
    line = " ".join(vocabulary(50, 60)) + " "
    votes, _ = quality.describe([(line * n).encode() for n in (4, 20, 100)] + [" ".join(vocabulary(51, 3000)).encode()])
    at = quality.LABELLERS.index("variety")
    assert list(votes[:, at]) == [0, 0, 0, -1]


def test_proximity_by_brute_force(spark):
    """The index alone and the whole operator give the same matches as a plain search, also at the borders of cells and for long windows."""
    r, words = random.Random(23), vocabulary(23, 30)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    benchmark = [(i, text(r.randrange(3, 14))) for i in range(8)] + [(8, " ".join(f"w{k}" for k in range(45))), (9, "lonely")]
    items = []
    for i in range(40):
        w = text(r.randrange(0, 50)).split()
        parts = benchmark[r.randrange(10)][1].split()
        for _ in range(r.randrange(0, 3)):
            k = r.randrange(len(parts))
            parts[k : k + r.randrange(0, 2)] = [r.choice(words)]
        items.append((i, " ".join(w + parts + text(r.randrange(0, 9)).split())))
    items += [(50, None), (51, ""), items[0]]
    docs, bench = frame(spark, items), spark.createDataFrame(benchmark, "item_id long, text string")
    for width, slop in ((10, 2), (10, 0), (40, 1)):
        sizes, hits, near, pairs = decontamination.find(docs, bench, width, slop)
        windows, _ = decontamination.benchmark_windows(bench, width)
        terms = windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct().withColumn("term_id", F.xxhash64("term"))
        index = decontamination.build_index(docs.select("doc_id", "text"), terms, 1)
        rows = decontamination.anchors(windows, terms, index.groupBy("term_id").agg(F.count("*").alias("f")))
        # Repeated rows count in frequencies here and in the operator alike.
        anchors = {}
        for x in rows.join(terms, "term_id").collect():
            anchors.setdefault(x.window, []).append((x.r, x.offset, x.term))
        wanted = set()
        for i, t in items:
            w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
            for window, found in anchors.items():
                (_, first, term), *rest = sorted(found)
                for p, x in enumerate(w):
                    if x == term and all(any(0 <= p - first + o + d < len(w) and w[p - first + o + d] == y for d in range(-slop, slop + 1)) for _, o, y in rest):
                        wanted.add((i, window))
        assert {(x.doc_id, x.window) for x in near.collect()} == wanted and wanted
        assert {(x.doc_id, x.window) for x in decontamination.proximity(index, rows, 1, slop).collect()} == wanted
